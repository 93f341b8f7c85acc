"""Documents that every text operator must take: nulls, empty and long texts, repeated rows and ids, clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, hash long, node long, slice int, digest string, length long, rank long"

WORDS = "the of and to in is that for it was on are as with his they at be this from have or by one had not but what all were when we there can".split()


def plain(n: int, seed: int = 1) -> str:
    state, out = seed, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 7 % len(WORDS)] + str(state // 1000 % 97))
    return " ".join(out)


TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, plain(60)),
    (4, plain(60)),
    (5, plain(60)),
    (6, plain(60) + " changed"),
    (None, plain(40, 9)),
    (7, "word " * 30_000),
    (8, plain(9_000, 3)),
    (9, "Ünïcödé 漢字 😀 it's we'll  \n\n end   "),
    (10, "a"),
    (11, "one two three"),
    (12, "### $$$ %%% &&& ***"),
    (13, "line one\nline one\n\nline one \nother"),
    (14, "x" * 20_000),
]


def frame(spark, rows=TEXTS):
    full = [(i, t, "en", "s", len(t or ""), 0.5, 1, 2, 3, 4, "d", 5, 6) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
