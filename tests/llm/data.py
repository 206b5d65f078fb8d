"""Small corpora with the hard cases: nulls, empty and long texts, copies, clashing column names."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, words=400):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    return [rng.choice(pool) for _ in range(n)]


def changed(words, seed, n):
    """The words with n of them replaced."""
    rng, out = random.Random(seed), list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randint(0, 10**6)}"
    return out


def frame(spark, rows):
    """rows: (doc_id, text) or all columns; the other columns hold what must not matter."""
    full = [(*r, "en", "s", len(r[1] or "")) if len(r) == 2 else r for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """Extra columns with names that operators use inside."""
    names = ["mark", "node", "band", "runs", "scan", "_scan", "ids", "id", "f", "_id", "_mark", "cell", "key", "first", "n", "digest", "distance"]
    return df.select("*", *(F.lit(f"x{k}").alias(n) for k, n in enumerate(names)))
