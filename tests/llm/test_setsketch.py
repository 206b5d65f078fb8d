import random
import re

import numpy as np
import pytest
from data import changed, clashing, frame, prose

from tidemark.llm import setsketch
from tidemark.llm.graph import components


def shingle_set(text, size):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(docs, size, percent):
    sets = [shingle_set(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            same = docs[a][0] is not None and docs[a][0] == docs[b][0] and docs[a][1] == docs[b][1]
            both = len(sets[a] & sets[b])
            if same or both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(((docs[k][0], len(sets[k]), least.get(find(k)), docs[k][0] == least.get(find(k))) for k in range(len(docs))), key=str)


def corpus(copies):
    rng = random.Random(1)
    docs = [(k, " ".join(prose(k, rng.randint(1, 120)))) for k in range(40)]
    base, other = prose(500, 150), prose(501, 300)
    docs += [(1000 + k, " ".join(changed(base, k, rng.randint(0, 14)))) for k in range(copies)]
    docs += [(5000 + k, " ".join(changed(other, k, k % 9))) for k in range(12)]
    chain = prose(502, 200)
    for k in range(8):
        chain = changed(chain, 70 + k, 5)
        docs.append((6000 + k, " ".join(chain)))
    docs += [(7000 + k, " ".join(base[: 150 - 3 * k])) for k in range(12)]
    docs += [(8000, None), (8001, ""), (8002, " \n\t"), (8003, "One two"), (8004, "one  TWO"), (8005, "one"), (8006, "two one"), (8007, "one two"), (8010, "one\u00a0two")]
    docs += [(8008, docs[0][1]), (8008, docs[0][1]), (None, docs[1][1]), (None, "only null ids here"), (8009, " ".join(prose(9, 30000)))]
    return docs


@pytest.mark.parametrize("size,percent,few", [(3, 85, 32), (5, 80, 8)])
def test_components_against_brute_force(spark, monkeypatch, size, percent, few):
    monkeypatch.setattr(setsketch, "FEW", few)
    docs = corpus(150)
    found = setsketch.near_duplicates(clashing(frame(spark, docs)), size, percent)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, size, percent)


def test_empty_table_and_no_links(spark):
    assert setsketch.near_duplicates(frame(spark, [])).collect() == []
    found = setsketch.near_duplicates(frame(spark, [(2, "a b c d e f"), (1, None)])).collect()
    assert sorted(tuple(r) for r in found) == [(1, 0, 1, True), (2, 2, 2, True)]


def test_keep_one(spark):
    docs = clashing(frame(spark, corpus(20)))
    kept = setsketch.keep_one(docs, 3, 85)
    wanted = sorted(r[0] for r in brute(corpus(20), 3, 85) if r[3] and r[0] is not None)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").where("doc_id IS NOT NULL").collect()) == wanted


def test_registers_estimate_similarity_and_merge():
    rng = np.random.default_rng(2)
    for n, shared in ((50, 40), (2000, 1500), (2000, 0), (300, 300)):
        every = np.unique(rng.integers(0, 2**63, 4 * n).astype(np.uint64))
        a, b = every[:n], np.concatenate([every[:shared], every[2 * n : 3 * n - shared]])
        ra, rb, rab = setsketch.registers([a, b, np.union1d(a, b)])
        assert (np.maximum(ra, rb) == rab).all()
        truth = shared / (2 * n - shared)
        estimate = setsketch.similarity(ra[None], rb[None], np.array([n]), np.array([n]))[0]
        assert abs(estimate - truth) < 4 * (truth * (1 - truth) / 125) ** 0.5 + 0.03


def test_components_of_long_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (3, 4), (4, 3)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r.node: r.root for r in rows}
    assert len(rows) == len(found) == 61 + 61 + 2
    assert {found[k] for k in range(100, 161)} == {100} and {found[k] for k in range(200, 260)} == {7} and found[4] == found[3] == 3


def test_keep_one_with_an_id_on_two_texts(spark):
    a, b = prose(11, 80), prose(12, 80)
    rows = [(1, " ".join(a)), (7, " ".join(changed(a, 1, 1))), (7, " ".join(b)), (9, " ".join(b)), (9, None), (8, None)]
    kept = setsketch.keep_one(clashing(frame(spark, rows)), 3, 85)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((k, t or "") for k, t in (rows[0], rows[2], rows[4], rows[5]))
