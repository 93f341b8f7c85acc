import re

from derrick.llm import license_rules
from tests.llm.cases import TEXTS, empty, frame

SEPARATOR = re.compile(license_rules.NOT_WORD)


def brute_base(text):
    words = [w for w in SEPARATOR.split((text or "").translate({k: k + 32 for k in range(65, 91)})) if w]
    places = [(i, label) for phrase, label in license_rules.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def brute_labels(text):
    """Rules in order over word intervals: a hit that only has words of earlier hits is suppressed."""
    words = [w for w in SEPARATOR.split((text or "").translate({k: k + 32 for k in range(65, 91)})) if w]
    line = "".join(f" {w} " for w in words)
    taken, labels = set(), set(filter(None, brute_base(text)[4].split(",")))
    for rule in license_rules.rules():
        if rule["keyword"] not in line:
            continue
        spans = []
        for hit in re.finditer(rule["pattern"], line):
            first = line[: hit.start()].count(" ") // 2
            spans.append(set(range(first, first + hit[0].count(" ") // 2)))
        if any(not s <= taken for s in spans):
            labels.add(rule["label"])
        taken.update(*spans)
    return ",".join(sorted(labels))


NOTICES = [
    "CC BY cc-by CC BY 4.0",
    "GNU General Public License, version 3 or later. All rights reserved",
    "Licensed under the Apache License, Version 2.0. The Apache License is short.",
    "Released under the MIT License.",
    "Licensed under CC BY-NC 4.0. cc by nc sa 3.0",
    "GNU Lesser General Public License version 2.1; see the MIT licence",
    "über cc BYK general public licensé",
    "mit license " * 2000,
    "The Apache license is nice, also the LGPL and BSD 3-clause",
    "copyright 2020 creative commons attribution sharealike 4.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy, without warranty of any kind",
    "general public general public license all rights reserved rights reserved",
    "AGPL v3, GPLv2 or later, MPL 2.0, EUPL v1.2, dedicated to the public domain",
]


def test_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate([t for _, t in TEXTS] + NOTICES)]
    for r in license_rules.scan(frame(spark, rows)).collect():
        text = rows[r.doc_id][1]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert r.labels == brute_labels(text)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = license_rules.scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (*brute_base(texts[r.doc_id]), brute_labels(texts[r.doc_id]))


def test_containment():
    assert brute_labels("Apache License, Version 2.0") == "apache-2.0"


def test_rules_are_many_and_gated():
    rules = license_rules.rules()
    assert len(rules) >= 200 and len({r["pattern"] for r in rules}) == len(rules)


def test_gates_let_every_rule_through():
    """The shortest text of each rule passes the prefilter: its words without the optional ones."""
    for rule in license_rules.rules():
        shortest = re.sub(r"\(\?: \(\?:[^()]*\)\x01\? \)\?", "", rule["pattern"])
        assert any(g in shortest for g in license_rules.GATES), shortest
        assert rule["keyword"].strip() in shortest, shortest


def test_empty_table(spark):
    assert license_rules.scan(empty(spark)).count() == 0
