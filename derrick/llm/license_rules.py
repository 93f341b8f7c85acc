"""Licence detection with ordered signature rules, on built-in functions only.

Texts are reduced to words, each wrapped in its own spaces. A rule is a pattern
of words with a keyword that must occur before its regular expression is tried, a label, a
priority and a confidence. Rules run from the highest priority down. A matched word is
marked; a later detection that lies wholly within words marked before is contained in what
a better rule has explained, and is suppressed. One with a word of its own counts.

Base phrases (``BASE``) are counted besides, wherever their words stand in a row;
their labels are always kept.

Cases: null counts as empty; texts without words have zero counts, null places,
empty labels and score 0; every text is searched whole; a text may carry any number of labels. Equal
rows stay equal rows. Only doc_id and text are read.
"""

from __future__ import annotations

import json
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
MARK = "\x01"

# Phrase, label.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
BASE_SCORE = 0.6

# One of these stands in every text that a rule or a base phrase can match.
GATES = ["licen", "gpl", "creative", "cc", "copyright", "reserved", "domain", "redistribution", "warrant", "proprietary", "permission", "mpl", "eupl", "cddl", "apache", "bsd", "wtfpl", "ncsa"]

LICENSE = "licen[sc]e"


def _words(pattern: str) -> str:
    """Regular expression of a row of words. ``word?`` may be absent; a word may be a group of choices."""
    out = []
    for word in pattern.split():
        optional = word.endswith("?") and not word.endswith(")?")
        body = f" (?:{word[:-1] if optional else word}){MARK}? "
        out.append(f"(?:{body})?" if optional else body)
    return "".join(out)


def _versioned() -> list[tuple[str, str, str, list[str]]]:
    """Families with versions: label, keyword, forms of the name with a place for the version, versions."""
    return [
        ("apache", "apache", [f"apache software? {LICENSE} version? {{}}", f"apache {{}} {LICENSE}?", f"under the? apache {LICENSE} v? {{}}"], ["1 0", "1 1", "2 0"]),
        ("gpl", "general", [f"gnu? general public {LICENSE} version? {{}} or later", f"gnu? general public {LICENSE} version? {{}} only?", f"version {{}} of the gnu? general public {LICENSE}"], ["1 0", "2 0", "3 0", "1", "2", "3"]),
        ("gpl", "gpl", ["gnu? gpl v? {} or later", "gnu? gpl v? {} only?"], ["1 0", "2 0", "3 0", "1", "2", "3"]),
        ("gpl", "gplv3", ["gplv3 or? later?"], [""]),
        ("gpl", "gplv2", ["gplv2 or? later?"], [""]),
        ("lgpl", "lesser", [f"gnu? lesser general public {LICENSE} version? {{}} or? later?"], ["2 1", "3 0", "3"]),
        ("lgpl", "library", [f"gnu? library general public {LICENSE} version? {{}} or? later?"], ["2 0", "2"]),
        ("lgpl", "lgpl", ["gnu? lgpl v? {} or? later?"], ["2 0", "2 1", "3 0", "2", "3"]),
        ("agpl", "affero", [f"gnu? affero general public {LICENSE} version? {{}} or? later?"], ["1 0", "3 0", "3"]),
        ("agpl", "agpl", ["gnu? agpl v? {} or? later?"], ["1 0", "3 0", "3"]),
        ("gfdl", "documentation", [f"gnu? free documentation {LICENSE} version? {{}} or? later?"], ["1 1", "1 2", "1 3"]),
        ("mpl", "mozilla", [f"mozilla public {LICENSE} version? v? {{}}"], ["1 0", "1 1", "2 0"]),
        ("mpl", "mpl", ["mpl v? {}"], ["1 0", "1 1", "2 0"]),
        ("epl", "eclipse", [f"eclipse public {LICENSE} version? v? {{}}"], ["1 0", "2 0"]),
        ("cddl", "distribution", [f"common development and distribution {LICENSE} version? {{}}"], ["1 0", "1 1"]),
        ("cddl", "cddl", ["cddl v? {}"], ["1 0", "1 1"]),
        ("eupl", "union", [f"european union public {LICENSE} version? v? {{}}"], ["1 0", "1 1", "1 2"]),
        ("eupl", "eupl", ["eupl v? {}"], ["1 0", "1 1", "1 2"]),
        ("artistic", "artistic", [f"artistic {LICENSE} version? {{}}"], ["1 0", "2 0"]),
        ("ofl", "font", [f"sil? open font {LICENSE} version? {{}}"], ["1 0", "1 1"]),
        ("afl", "academic", [f"academic free {LICENSE} version? v? {{}}"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
        ("osl", "software", [f"open software {LICENSE} version? v? {{}}"], ["1 0", "1 1", "2 0", "2 1", "3 0"]),
        ("cpl", "common", [f"common public {LICENSE} version? {{}}"], ["1 0"]),
        ("bsl", "boost", [f"boost software {LICENSE} version? {{}}"], ["1 0"]),
        ("psf", "python", [f"python software foundation {LICENSE} version? {{}}"], ["2"]),
        ("php", "php", [f"php {LICENSE} version? {{}}"], ["3 0", "3 01"]),
        ("zpl", "zope", [f"zope public {LICENSE} version? {{}}"], ["1 1", "2 0", "2 1"]),
        ("lppl", "project", [f"latex project public {LICENSE} version? {{}}"], ["1 0", "1 1", "1 2", "1 3", "1 3a", "1 3c"]),
        ("odbl", "database", [f"open database {LICENSE} version? v? {{}}"], ["1 0"]),
        ("busl", "business", [f"business source {LICENSE} version? {{}}"], ["1 0", "1 1"]),
        ("qpl", "q", [f"q public {LICENSE} version? {{}}"], ["1 0"]),
        ("npl", "netscape", [f"netscape public {LICENSE} version? {{}}"], ["1 0", "1 1"]),
    ]


# Rules without versions: label, keyword, pattern, confidence.
PLAIN = [
    ("mit", "mit", f"under the? mit {LICENSE}", 0.98),
    ("mit", "mit", f"(?:the|this|an) mit {LICENSE}", 0.95),
    ("mit", "mit", f"mit {LICENSE}", 0.9),
    ("mit", "expat", f"expat {LICENSE}", 0.9),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 0.98),
    ("isc", "isc", f"isc {LICENSE}", 0.9),
    ("isc", "permission", "permission to use copy modify and(?:or)? or? distribute this software for any purpose with or without fee", 0.95),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 0.98),
    ("bsd", "bsd", f"bsd {LICENSE}", 0.85),
    ("bsd", "bsd", f"bsd style {LICENSE}?", 0.7),
    ("bsd-2-clause", "bsd", f"(?:2|two) clause bsd {LICENSE}?", 0.97),
    ("bsd-2-clause", "bsd", f"bsd (?:2|two) clause {LICENSE}?", 0.97),
    ("bsd-2-clause", "bsd", f"(?:simplified|freebsd) bsd {LICENSE}", 0.95),
    ("bsd-3-clause", "bsd", f"(?:3|three) clause bsd {LICENSE}?", 0.97),
    ("bsd-3-clause", "bsd", f"bsd (?:3|three) clause {LICENSE}?", 0.97),
    ("bsd-3-clause", "bsd", f"(?:new|modified|revised) bsd {LICENSE}", 0.95),
    ("bsd-4-clause", "bsd", f"(?:4|four) clause bsd {LICENSE}?", 0.97),
    ("bsd-4-clause", "bsd", f"(?:original|old) bsd {LICENSE}", 0.93),
    ("0bsd", "0bsd", "0bsd", 0.9),
    ("apache", "apache", f"apache software? {LICENSE}", 0.85),
    ("gpl", "general", f"gnu? general public {LICENSE}", 0.85),
    ("gpl", "gpl", "gnu? gpl", 0.75),
    ("lgpl", "lesser", f"lesser general public {LICENSE}", 0.85),
    ("lgpl", "lgpl", "lgpl", 0.75),
    ("agpl", "affero", f"affero general public {LICENSE}", 0.85),
    ("agpl", "agpl", "agpl", 0.75),
    ("gfdl", "documentation", f"free documentation {LICENSE}", 0.85),
    ("mpl", "mozilla", f"mozilla public {LICENSE}", 0.85),
    ("epl", "eclipse", f"eclipse public {LICENSE}", 0.85),
    ("artistic", "artistic", f"artistic {LICENSE}", 0.8),
    ("ofl", "font", f"open font {LICENSE}", 0.85),
    ("zlib", "zlib", f"zlib (?:libpng)? {LICENSE}", 0.9),
    ("unlicense", "unlicense", "unlicense", 0.9),
    ("wtfpl", "wtfpl", "wtfpl", 0.9),
    ("wtfpl", "want", "do what the? (?:fuck|f) you want to public license", 0.95),
    ("boost", "boost", f"boost software {LICENSE}", 0.9),
    ("ncsa", "ncsa", f"ncsa (?:open|license|licence)", 0.85),
    ("postgresql", "postgresql", f"postgresql {LICENSE}", 0.9),
    ("x11", "x11", f"x11 {LICENSE}", 0.9),
    ("ms-pl", "microsoft", f"microsoft public {LICENSE}", 0.9),
    ("ms-rl", "microsoft", f"microsoft reciprocal {LICENSE}", 0.9),
    ("openssl", "openssl", f"openssl {LICENSE}", 0.9),
    ("curl", "curl", f"curl {LICENSE}", 0.8),
    ("odc-by", "data", f"open data commons attribution {LICENSE}", 0.95),
    ("pddl", "dedication", f"public domain dedication and {LICENSE}", 0.95),
    ("cc0", "cc0", "cc0 (?:1)? (?:0)?", 0.95),
    ("cc0", "zero", "creative commons zero", 0.95),
    ("public-domain", "domain", "(?:dedicated|released|placed) (?:to|into|in) the public domain", 0.9),
    ("public-domain", "domain", "(?:is|are) in the public domain", 0.8),
    ("cc", "commons", f"creative commons {LICENSE}?", 0.6),
    ("reserved", "reserved", "(?:all|some|no) rights reserved", 0.8),
    ("proprietary", "proprietary", "proprietary and confidential", 0.9),
    ("proprietary", "proprietary", f"proprietary (?:license|licence|software)", 0.7),
    ("commercial", "commercial", f"commercial {LICENSE} (?:agreement|terms)?", 0.7),
    ("eula", "user", f"end user {LICENSE} agreement", 0.9),
    ("copyright", "copyright", "copyright (?:c|©)? (?:19|20)[0-9][0-9]", 0.5),
    ("copyright", "copyright", "copyright holders?", 0.5),
    ("no-warranty", "warranty", "without warranty of any kind", 0.5),
    ("no-warranty", "warranties", "without warranties or conditions of any kind", 0.5),
]

# Creative Commons: short names and their long forms, in every combination with a version.
CC_PARTS = [
    ("by", "attribution"),
    ("by-sa", "attribution share alike"),
    ("by-sa", "attribution sharealike"),
    ("by-nc", "attribution non commercial"),
    ("by-nc", "attribution noncommercial"),
    ("by-nd", "attribution no derivatives"),
    ("by-nd", "attribution noderivatives"),
    ("by-nc-sa", "attribution noncommercial sharealike"),
    ("by-nc-nd", "attribution noncommercial noderivatives"),
]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]


def rules() -> list[dict]:
    """All rules from the highest priority to the lowest: longer patterns first, at equal length the surer ones."""
    found: dict[str, dict] = {}

    def add(label: str, keyword: str, pattern: str, confidence: float) -> None:
        n = sum(not word.endswith("?") or word.endswith(")?") for word in pattern.split())
        found.setdefault(pattern, {"label": label, "keyword": f" {keyword}", "pattern": _words(pattern), "confidence": confidence, "n": n})

    for label, keyword, forms, versions in _versioned():
        for form, version in product(forms, versions):
            name = f"{label}-{version.replace(' ', '.')}" if version else label
            add(name, keyword, " ".join(form.format(version).split()), 0.98)
    for label, keyword, pattern, confidence in PLAIN:
        add(label, keyword, pattern, confidence)
    for short, long in CC_PARTS:
        for version in CC_VERSIONS:
            name = f"cc-{short}-{version.replace(' ', '.')}"
            add(name, "cc", f"cc {short.replace('-', ' ')} {version}", 0.98)
            add(name, "commons", f"creative commons {long} {version}", 0.98)
        add(f"cc-{short}", "cc", f"cc {short.replace('-', ' ')}", 0.85)
        add(f"cc-{short}", "commons", f"creative commons {long}", 0.85)
    ordered = sorted(found.values(), key=lambda r: (-r["n"], -r["confidence"], r["label"], r["pattern"]))
    return [{k: r[k] for k in ("label", "keyword", "pattern", "confidence")} for r in ordered]


def _count(text: Column, part: str) -> Column:
    """How often ``part`` occurs in a text without overlapping itself."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def _wrapped(phrase: str) -> str:
    return "".join(f" {word} " for word in phrase.split())


def _detected(text: Column) -> Column:
    """text, labels and score after all rules have been applied in order."""
    table = F.from_json(F.lit(json.dumps(rules())), "array<struct<label:string,keyword:string,pattern:string,confidence:double>>")
    tried = F.filter(table, lambda r: F.contains(text, r.keyword))
    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def marked(hit: Column) -> Column:
        return F.regexp_replace(hit, f"([^ {MARK}]){MARK}? ", f"$1{MARK} ")

    def apply(done: Column, r: Column) -> Column:
        hits = F.regexp_extract_all(done.text, r.pattern, F.lit(0))
        # A hit with an unmarked word isn't contained in what better rules have matched.
        fresh = F.exists(hits, lambda h: _count(h, f"{MARK} ") * 2 < _count(h, " "))
        text_after = F.array_join(F.zip_with(F.split(done.text, r.pattern, F.lit(-1)), hits, lambda gap, hit: F.concat(gap, marked(F.coalesce(hit, F.lit(""))))), "")
        after = F.struct(
            text_after.alias("text"),
            F.when(fresh, F.array_union(done.labels, F.array(r.label))).otherwise(done.labels).alias("labels"),
            F.when(fresh, F.greatest(done.score, r.confidence)).otherwise(done.score).alias("score"),
        )
        return F.when(F.regexp_like(done.text, r.pattern), after).otherwise(done)

    return F.aggregate(tried, start, apply)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document."""
    text = F.coalesce("text", F.lit(""))
    source = docs.select("doc_id", text.alias("text"))
    low = F.lower("text")
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains("low", F.lit(word))
    counted = source.select("doc_id", "text", F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"), low.alias("low"))
    spaced = F.regexp_replace(F.translate("text", UPPER, LOWER), NOT_WORD, "  ")
    gated = counted.select("doc_id", "n_words", F.when(gate, F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))).alias("words"))

    words = F.col("words")
    n = [_count(words, _wrapped(phrase)) for phrase, _ in BASE]
    before = [F.when(F.contains(words, F.lit(_wrapped(p))), _count(F.substring_index(words, _wrapped(p), 1), " ") / 2) for p, _ in BASE]
    behind = [F.when(F.contains(words, F.lit(_wrapped(p))), F.col("n_words") - _count(F.substring_index(words, _wrapped(p), -1), " ") / 2 - len(p.split())) for p, _ in BASE]
    own = F.filter(F.array(*[F.when(k > 0, F.lit(label)) for k, (_, label) in zip(n, BASE, strict=True)]), lambda x: x.isNotNull())
    found = gated.select(
        "doc_id",
        "n_words",
        F.coalesce(sum(n[1:], n[0]), F.lit(0)).cast("long").alias("n_base"),
        F.least(*before).cast("long").alias("first_word"),
        F.greatest(*behind).cast("long").alias("last_word"),
        own.alias("own"),
        F.when(words.isNotNull(), _detected(words)).alias("found"),
    )
    none = F.array().cast("array<string>")
    everything = F.array_sort(F.array_distinct(F.concat("own", F.coalesce("found.labels", none))))
    base_score = F.when(F.size("own") > 0, BASE_SCORE).otherwise(0.0)
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(everything, ",").alias("labels"),
        F.greatest(base_score, F.coalesce("found.score", F.lit(0.0))).alias("score"),
    )
