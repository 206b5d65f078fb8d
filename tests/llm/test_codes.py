import hashlib
import math
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """Plain Lloyd rounds with Python integers."""
    fits = [(i, v, lab) for i, v, lab in rows if v and len(v) % 4 == 0 and all(x is not None and math.isfinite(x) for x in v)]
    fits = sorted(((i, [min(max(math.floor(1024 * x), -codes.WIDEST), codes.WIDEST) for x in v], lab) for i, v, lab in fits), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fits = [r for r in fits if len(r[1]) == len(fits[0][1])]
    part = lambda x, p: x[len(x) // 4 * p : len(x) // 4 * (p + 1)]
    books = [[part(x, p) for _, x, _ in fits[: codes.ENTRIES]] for p in range(4)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest():
        return [[min((gap(part(x, p), e), k) for k, e in enumerate(books[p])) for p in range(4)] for _, x, _ in fits]

    for _ in range(4):
        found = nearest()
        for p in range(4):
            held = defaultdict(list)
            for (_, x, _), near in zip(fits, found):
                held[near[p][1]].append(part(x, p))
            for k, xs in held.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    found, sums = nearest(), defaultdict(int)
    for (_, _, lab), near in zip(fits, found):
        sums[lab] += sum(d for d, _ in near)
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    held = lambda x: min(x, 2**63 - 1)
    out = [(i, "".join(f"{k:02x}" for _, k in near), held(sum(d for d, _ in near)), held(sums[lab]), sha) for (i, _, lab), near in zip(fits, found)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def corpus(n=700, d=8):
    rng = random.Random(2)
    rows = [(1000 - k, [round(rng.gauss(0, 0.3), 2) for _ in range(d)], rng.choice([0, 0, 1, None])) for k in range(n)]
    rows += [(k, [0.5] * d, 1) for k in range(1500, 1600)] + [rows[0], rows[1], (5000, [float("nan")] * d, 1), (5001, None, 1), (5002, [None] * d, 1)]
    return rows + [(5003, [float("inf")] * d, 1), (5004, [], 1), (5005, [0.1] * (d + 4), 1), (5006, [0.1] * 7, 1), (None, [0.2] * d, 2), (5007, [-0.0] * d, 2)]


def test_against_plain_rounds(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    extra = df.select("*", *(F.lit("x").alias(n) for n in ("x", "codes", "row", "distances", "total", "_salt")))
    assert rows_of(codes.compressed(extra.repartition(5))) == brute(corpus())


def test_few_and_wide_vectors(spark, monkeypatch):
    few = corpus(30)
    monkeypatch.setattr(codes, "ENTRIES", 9)
    wide = few + [(7000, [1e6, -3e9] * 4, 1), (7001, [1e300] * 8, 0), (7002, [-1e300, 1e12] * 4, None)]
    for rows in (few, wide):
        assert rows_of(codes.compressed(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_settled_rows_meet_only_moved_entries(monkeypatch):
    rng = np.random.default_rng(0)
    x, book = rng.integers(-50, 50, (500, 3)), rng.integers(-50, 50, (40, 3))
    at, near = codes.assigned(x, book, None, np.zeros(500, int), np.zeros(500, object))
    after = book.copy()
    after[[3, 9]] += 7
    moved = (after != book).any(1)
    seen, real = [], codes.distances
    monkeypatch.setattr(codes, "distances", lambda a, e: seen.append((len(a), len(e))) or real(a, e))
    found = codes.assigned(x, after, moved, at, near)
    whole = real(x, after)
    assert (found[0] == whole.argmin(1)).all() and (found[1] == whole.min(1)).all()
    assert sorted(seen) == sorted([(int(moved[at].sum()), 40), (int((~moved[at]).sum()), 2)])


def test_empty_table(spark):
    df = spark.createDataFrame(corpus()[:3], SCHEMA)
    assert codes.compressed(df.limit(0)).collect() == []
    assert codes.compressed(df.withColumn("embedding", F.lit(None).cast("array<double>"))).collect() == []
