"""Small tables with what operators must bear: nulls, empty and long texts, repeated rows, clashing columns."""

import random

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, fp string, score string, k1 string, word string, n int"
CLASHING = (1, "x", "y", "z", "w", 2)


def documents(spark, rows):
    """``rows``: (doc_id, text), beside columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None, *CLASHING) for i, t in rows], SCHEMA).repartition(3)


def collected(df, *key):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple((r[k] is None, r[k]) for k in key))


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("", "n", "ra", "lis", "to", "mé", "sk", "ve", "du", "po")][:vocabulary]
    return " ".join(rng.choice(words) for _ in range(n))


def awkward(seed=0):
    """Rows no operator may trip over."""
    base = prose(300, seed)
    return [
        (1, base), (2, base), (2, base), (3, None), (4, ""), (None, base), (None, None), (5, " \n\t "), (6, "one"),
        (7, prose(20_000, seed + 1)), (8, "é " * 300), (9, base + " tail"), (10, "a\n\na\n" * 50),
    ]
