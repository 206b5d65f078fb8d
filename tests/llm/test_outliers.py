import collections
import random
import re

import numpy as np
import pandas as pd
import pytest
from data import clashing, prose
from pyspark.sql import functions as F

from tidemark.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    counts = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for k in range(len(w) - 2) if counts[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)]


def corpus():
    rng = random.Random(8)
    rows = []
    for k in range(900):
        words = prose(k % 7, 60 + rng.randint(0, 400), 900)
        words = prose(5000 + k, len(words), 900)
        if k % 9 == 0:  # junk
            words = [w + rng.choice(["%%%", "$$$", " |", "***"]) for w in words]
        lang, source = rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "hot", "a", None])
        rows.append((k, " ".join(words), lang, source, 0))
    texts = [None, "", "\n\n", "a b c " * 400, "é ü\tñ " * 30, "x", "<|#$%&*>\n" * 60, "same line here\nsame line here\n " + " ".join(prose(3, 80))]
    rows += [(1000 + k, t, "en", "hot", 0) for k, t in enumerate(texts)]
    rows += [(2000, rows[1][1], None, None, None), (2000, rows[1][1], None, None, None), (None, rows[1][1], "fr", "rare", 0)]
    rows.append((2001, " ".join(prose(77, 60000, 900)), "en", "hot", 0))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def verdicts(spark):
    return outliers.judged(clashing(spark.createDataFrame(corpus(), SCHEMA))).collect()


def test_counts_and_base_rules_against_brute_force(verdicts):
    rows, found = corpus(), verdicts
    assert len(found) == len(rows)
    got = sorted(([r.doc_id, *(r[c] for c in outliers.COUNTS[:5]), r.base_failed, r.kept and r.base_failed] for r in found), key=str)
    wanted = []
    for row in rows:
        c = brute(row[1])
        wanted.append([row[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0], False])
    assert got == sorted(wanted, key=str)


def test_junk_goes_and_clean_texts_stay(verdicts):
    found = {r.doc_id: r for r in verdicts}
    junk, clean = [k for k in range(900) if k % 9 == 0], [k for k in range(900) if k % 9]
    assert sum(found[k].kept for k in junk) == 0
    assert all(found[k].kept for k in clean) and found[2001].kept and found[2000].kept


def test_accepted_keeps_rows_and_columns(spark, verdicts):
    docs = clashing(spark.createDataFrame(corpus(), SCHEMA))
    kept = outliers.accepted(docs)
    texts = [r.text for r in kept.select("text").collect()]
    assert kept.columns == docs.columns and len(texts) == sum(r.kept for r in verdicts) and None not in texts


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert outliers.accepted(empty).collect() == []


def test_estimates_resist_a_fifth_of_outliers(spark):
    """Location and scatter of a cell agree with those of its clean rows, as a plain numpy MCD finds them."""
    rng = np.random.default_rng(0)
    clean = rng.multivariate_normal([1, 0.2, 0.1, 0.3, 0.4], np.diag([0.3, 0.2, 0.25, 0.2, 0.3]) ** 2, 2000)
    bad = rng.normal(3, 0.1, (500, 5))
    rows = pd.DataFrame(np.concatenate([clean, bad]), columns=outliers.VECTOR).assign(cell="c")
    found = outliers.estimates(spark.createDataFrame(rows)).collect()[0]
    subset = np.concatenate([clean, bad])
    mean, cov = np.median(subset, 0), np.diag(np.var(clean, 0))
    for _ in range(30):  # concentration steps over all rows
        d = np.einsum("ij,jk,ik->i", subset - mean, np.linalg.inv(cov + np.diag(np.square(outliers.FLOORS))), subset - mean)
        own = subset[np.argsort(d)[: int(outliers.SHARE * len(subset))]]
        mean, cov = own.mean(0), np.cov(own.T, bias=True)
    assert np.abs(np.array(found.m) - mean).max() < 0.03
    p = {pair: v for pair, v in zip(outliers._PAIRS, found.p)}
    far = np.array([3.0] * 5) - np.array(found.m)
    assert sum(v * far[i] * far[j] for (i, j), v in p.items()) > 100


def test_every_language_and_source_has_estimates_of_its_own(spark, sf):
    """On the given tables, and in cells of 1 to 60 texts, which lean the more to their language the fewer they are."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").where("text IS NOT NULL")
    stats = outliers.with_counts(docs.withColumn("mark", F.xxhash64("text")), ["doc_id", "lang", "source"]).where(~outliers.base_failed())
    named = outliers._named(stats.select("*", *outliers._vector()))
    cells = outliers.cell_estimates(named).collect()
    assert len(cells) == len({tuple(r.m) for r in cells}) == named.select("lang", "source").distinct().count() > 40

    rng = np.random.default_rng(1)
    sizes = {"one": 1, "few": 8, "some": 60, "many": 2000}
    places = {"one": 0.9, "few": 0.9, "some": 0.9, "many": 0.0}
    rows = [("en", s, *map(float, rng.normal(places[s], 0.1, 5))) for s, n in sizes.items() for _ in range(n)]
    found = {r.own: r for r in outliers.cell_estimates(outliers._named(spark.createDataFrame(rows, ["lang", "source", *outliers.VECTOR]))).collect()}
    at = {s: found[f'["=en","={s}"]'].m[0] for s in sizes}
    assert 0 < at["one"] < at["few"] < at["some"] < 0.9 and abs(at["many"]) < 0.05
    assert at["some"] > 0.6 and at["one"] < 0.15


def test_leaning_is_the_mixture_of_both():
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (400, 5)) @ rng.normal(0, 1, (5, 5)), rng.normal(0.5, 1, (20, 5))
    upper = lambda x: np.array([v[i, j] * (1 if i == j else 2) for v in [np.linalg.inv(np.cov(x.T, bias=True))] for i, j in outliers._PAIRS])
    m, p = outliers.leaning(400, a.mean(0), upper(a), b.mean(0), upper(b))
    both = np.concatenate([a, b])
    assert outliers.PRIOR == len(b) and np.allclose(m, both.mean(0)) and np.allclose(p, upper(both))


def test_repeats_alone_can_reject(spark):
    """Texts of which nearly half are repeated phrases, below what the base rules reject."""
    rng = random.Random(6)
    rows = []
    for k in range(300):
        words = prose(100 + k, 400, 900)
        if k < 12:
            phrase = prose(7000 + k, 6, 900)
            words = words[:220] + phrase * 30
        rows.append((k, " ".join(words), "en", rng.choice("ab"), 0))
    found = {r.doc_id: r for r in outliers.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(found[k].base_failed for k in range(300))
    assert [k for k in range(300) if not found[k].kept] == list(range(12))


def test_two_fifths_of_junk_and_a_hot_junk_text_go(spark):
    """A cell with 33 % copies of one junk text and 12 % other junk, and one with 42 % different junk."""
    rng = random.Random(4)
    spoilt = lambda words: [w + rng.choice(["%%%", "$$$", " |", "***"]) for w in words]
    rows, junk = [], set()
    copied = " ".join(spoilt(prose(1, 200, 900)))
    for source, hot, other in (("copies", 300, 108), ("mixed", 0, 378)):
        for k in range(900):
            words = prose(9000 + len(rows), 60 + rng.randint(0, 400), 900)
            if k < hot + other:
                junk.add(len(rows))
                words = spoilt(words)
            rows.append((len(rows), copied if k < hot else " ".join(words), "en", source, 0))
    kept = {r.doc_id for r in outliers.judged(spark.createDataFrame(rows, SCHEMA)).where("kept").collect()}
    assert kept == set(range(len(rows))) - junk


def test_floors_are_least_deviations():
    """A variance over its floor stays, one under it becomes the floor's."""
    wide = 4 * np.square(outliers.FLOORS)
    for variance, wanted in ((wide, wide), (wide / 100, wide / 4)):
        second = np.array([variance[i] if i == j else 0.0 for i, j in outliers._PAIRS])
        _, p, _ = outliers._estimate(1, np.zeros(5), second, np.zeros(5), 1.0)
        assert np.allclose([1 / v for v, (i, j) in zip(p, outliers._PAIRS) if i == j], wanted)
    assert abs(outliers._consistency(0.5) - 1.9) < 0.05
