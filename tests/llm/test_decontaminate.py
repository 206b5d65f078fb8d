import hashlib
import random
import re

import pytest
from data import clashing, frame, prose
from pyspark.sql import functions as F

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, window):
    found = {}
    for name, text in items:
        w = words(text)
        for k in range(max(0, len(w) - min(window, len(w)) + 1) if w else 0):
            found.setdefault(tuple(w[k : k + min(window, len(w))]), set()).add(str(name))
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in found}:
            for k in range(len(w) - size + 1):
                owners = found.get(tuple(w[k : k + size]))
                if owners:
                    hit.update(range(k, k + size))
                    names |= owners
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    items = [(k, " ".join(prose(k, rng.randint(14, 60), 30))) for k in range(20)]
    items += [(100, "Short One"), (101, "x"), (102, ""), (103, None), (104, items[3][1]), (105, "a b a b a b a b a b a b a b a b a b")]
    docs = []
    for k in range(60):
        w = prose(1000 + k, rng.randint(0, 300), 30)
        for _ in range(rng.randint(0, 3)):
            item = words(items[rng.randrange(20)][1])
            at = rng.randint(0, len(item))
            w[len(w) // 2 : len(w) // 2] = item[at : at + rng.randint(5, 40)]
        docs.append((k, (rng.choice([" ", "\n", "-", ". "])).join(w).title()))
    docs += [(60, None), (61, ""), (62, "SHORT, one x"), (63, "a b " * 5000), (64, items[3][1] + "é"), (64, items[3][1] + "é"), (None, items[5][1])]
    items += [(3, items[3][1]), (3, items[6][1]), (6, items[6][1]), (6, items[6][1])]  # rows that repeat an id, with the same and with other texts
    docs += [(65, "é" + items[2][1].upper()), (66, " ".join(prose(9, 40000, 30)))]
    return docs, items


def scores(spark, docs, items, window):
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.with_scan(clashing(frame(spark, docs)), tests, window)
    rows = found.select(
        "doc_id", "scan.n_words", decontaminate.n_hit().alias("h"), "scan.items", decontaminate.contaminated().alias("c")
    ).collect()
    return sorted(((r.doc_id, r.n_words, r.h, len(r["items"]), decontaminate.digest(r["items"]), r.c) for r in rows), key=str)


@pytest.mark.parametrize("window", [13, 3])
def test_windows_against_brute_force(spark, window):
    docs, items = corpus()
    assert scores(spark, docs, items, window) == brute(docs, items, window)


def test_blocks_of_test_items_give_the_same(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    assert scores(spark, docs, items, 13) == brute(docs, items, 13)


def test_empty_tables(spark):
    docs, items = corpus()
    assert scores(spark, [], items, 13) == []
    assert scores(spark, docs, [], 13) == brute(docs, [], 13)


def test_suffix_array_is_sorted():
    import numpy as np

    rng = np.random.default_rng(0)
    for depth in (1, 7, 60):
        ids = np.append(rng.integers(0, 4, 500), 0).astype(np.int32)
        array, _ = decontaminate.suffix_array(ids, 3, depth)
        upto = lambda p: (s := ids[p:].tolist())[: s.index(0)] if 0 in ids[p:] else ids[p:].tolist()
        assert sorted(array.tolist()) == np.flatnonzero(ids).tolist()
        cut = [upto(p)[:depth] for p in array]
        assert cut == sorted(cut)


def test_longest_matches(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = frame(spark, [(1, "a b " + " ".join(f"w{k}" for k in range(5, 25)) + " c"), (2, "nothing"), (3, None)])
    found = decontaminate.longest_matches(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [tuple(r) for r in found.collect()] == [(1, "7", 5, 2, 20)]


def longest(doc, items, window):
    """The longest common run of words by trying all pairs of places."""
    a, best = words(doc), (0,)
    for name, text in items:
        b = words(text)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if b and n >= min(window, len(b)):
                    best = min(best, (-n, i, str(name), j))
    return None if best == (0,) else best


@pytest.mark.parametrize("block_bytes", [1 << 20, 1000])
def test_longest_match_of_a_document(spark, monkeypatch, block_bytes):
    docs, items = corpus()
    docs = [d for d in docs[::4] if d[1] is None or len(d[1]) < 1000] + docs[62:63] + [(77, "q short one q " + " ".join(words(items[4][1])[3:]))]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    found = decontaminate.with_scan(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    got = [r["scan"]["longest"] for r in found.orderBy("doc_id").collect()]
    wanted = [longest(t, items, 13) for _, t in sorted(docs)]
    assert [None if g is None else (-g.n, g.doc_start, g.item_id, g.item_start) for g in got] == wanted and any(wanted)


def test_removal_keeps_rows_and_columns(spark):
    docs, items = corpus()
    df = clashing(frame(spark, docs))
    kept = decontaminate.remove_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    gone = sum(r[-1] for r in brute(docs, items, 13))
    assert 0 < gone and kept.count() == len(docs) - gone
    assert kept.where(F.col("doc_id") == 61).count() == 1
