import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import rotation

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.9):
    """All pairs, and what they reach."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for d in {len(v) for (_, v, _), g in zip(rows, good) if g}:
        at = [k for k in range(len(rows)) if good[k] and len(rows[k][1]) == d]
        x = np.array([rows[k][1] for k in at])
        x = x / np.abs(x).max(1)[:, None]
        c = x @ x.T / np.sqrt((x * x).sum(1)[:, None] * (x * x).sum(1)[None])
        for i, j in zip(*np.nonzero(np.triu(c >= cosine, 1))):
            links[at[i]], links[at[j]] = links[at[i]] + 1, links[at[j]] + 1
            up[root(at[i])] = root(at[j])
    least = {}
    for k, (i, _, _) in enumerate(rows):
        old = least.get(root(k))
        least[root(k)] = i if old is None else old if i is None else min(old, i)
    return sorted(((i, links[k], least[root(k)], i == least[root(k)]) for k, (i, _, _) in enumerate(rows)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def near(rng, centre, cosine):
    away = rng.standard_normal(len(centre))
    away -= away @ centre * centre / (centre @ centre)
    return centre * cosine + away * np.linalg.norm(centre) / np.linalg.norm(away) * math.sqrt(1 - cosine**2)


def corpus(n=800, d=24):
    rng = np.random.default_rng(4)
    rows = [rng.standard_normal(d) for _ in range(n)]
    for k in range(40):
        rows += [near(rng, rows[k], rng.uniform(0.86, 0.99)) for _ in range(k % 5)]
    rows += [near(rng, rows[50], 0.955) for _ in range(300)]  # a crowd whose pairs lie on both sides of the limit
    rows += [near(rng, rows[51], 0.999) for _ in range(150)] + [rows[52]] * 100 + [rows[52] * 1e-200, rows[51] * 1e150]
    rows = [(3 * k % 4001, list(map(float, v)), 0) for k, v in enumerate(rows)]
    rows += [(9000, None, 1), (9001, [], 1), (9002, [0.0] * d, 1), (9003, [float("nan")] * d, 1), (9004, [None] * d, 1), (9005, [float("inf")] * d, 1)]
    rows += [(9006, [1.0, 2.0], 1), (9007, [2.0, 4.1], 1), (9008, [-1.0, 2.0], 1), (9009, [3.0], 1), (9010, [-3.0], 1), (9011, [5.0], 1)]
    return rows + [(None, rows[52][1], 1), (None, (-np.array(rows[60][1])).tolist(), 1), rows[53], (rows[54][0], rows[55][1], 1)]


def test_against_all_pairs(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    extra = df.select("*", *(F.lit("q").alias(n) for n in ("x", "node", "key", "keys", "copies", "root", "links", "same", "least")))
    assert rows_of(rotation.near_vectors(extra.repartition(6))) == brute(corpus())


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(rotation, "BLOCK", 40)
    monkeypatch.setattr(rotation, "FEW", 4)
    assert rows_of(rotation.near_vectors(spark.createDataFrame(corpus(200), SCHEMA))) == brute(corpus(200))


@pytest.mark.parametrize("d", [3, 64, 100])
def test_estimates_are_unbiased_and_bounded(d):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((3000, d))
    y = np.array([near(rng, v, 0.9) for v in x])
    codes = rotation.Codes(*rotation.coded(rotation.units(np.concatenate([x, y]))))
    at = np.arange(len(x))
    found, sd = [], []
    for k in range(0, len(x), 500):
        a, b = slice(k, k + 500), slice(len(x) + k, len(x) + k + 500)
        found.append(np.diagonal(codes.estimates(a, b)))
        sd.append(np.diagonal(codes.deviation(a, b, 0.9)))
    off = np.concatenate(found) - 0.9
    assert abs(off.mean()) < 0.004
    assert off.std() < np.concatenate(sd).mean()
    assert (off >= -5 * np.concatenate(sd)).all() and len(at) == len(off)


def test_buckets_meet_as_often_as_stated():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 40))
    y = np.array([near(rng, v, 0.9) for v in x])
    for w in (1, 4, 7):
        a, b = (rotation.bucket_names(rotation.units(v), [w], 6) for v in (x, y))
        assert (a == b).mean() == pytest.approx(rotation.AGREE[w - 1], abs=0.01)
    parts, tables = rotation.plan(10**6)
    a, b = (rotation.bucket_names(rotation.units(v), parts, tables) for v in (x, y))
    assert (a == b).any(1).all()


def test_empty_table(spark):
    df = spark.createDataFrame(corpus(60)[:3], SCHEMA)
    assert rotation.near_vectors(df.limit(0)).collect() == []
    assert rows_of(rotation.near_vectors(df.withColumn("embedding", F.lit(None).cast("array<double>")))) == brute([(i, None, 0) for i, _, _ in corpus(60)[:3]])
