import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, rep string, score string, key string, text_key string, component string, part string"
WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "vo", "sha", "dru") for b in ("n", "rt", "sel", "ming", "dor", "quil")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS[:9]) for _ in range(n))


LONG = prose(1, 9000)
#: Nulls, empty and blank texts, a null id, ties, repeated rows, very long and very short texts.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (None, prose(2, 60)), (4, "a"), (5, LONG), (5, LONG), (6, "!!! ??"), (7, prose(3, 60)),
    (8, prose(3, 60)), (9, "ß é 漢字 \U0001f600"), (10, None), (None, None),
]


def documents(spark, rows, lang="en"):
    """A documents table with further columns whose names the operators use inside."""
    full = [(i, t, lang, "s", len(t or ""), *["x"] * 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
