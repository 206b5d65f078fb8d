import random
import re
import zlib
from collections import Counter

import pytest
from data import clashing, frame

from tidemark.llm import variants


def edits(a, b):
    """Whether a and b are one inserted, deleted or replaced code point apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            n[low if h % 97 else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if n[v] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def corpus():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcé×") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    stems += ["common" + "".join(rng.choice("ab") for _ in range(5)) for _ in range(30)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab"]
    docs = []
    for k in range(120):
        out = []
        for _ in range(rng.randint(0, 80)):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b", w[at] + "c", "ÿ"]) + w[at + 1 :]
            out.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((k, rng.choice([" ", ", ", "1", "\n", "œ"]).join(out)))
    long = "qwertyuiopasdf" * 3000
    docs += [(500, None), (501, ""), (502, "12 34"), (7, docs[7][1]), (None, docs[9][1]), (503, f"{long} {long} {long} {long}x {long}x x{long[1:]} " * 3)]
    return docs


@pytest.fixture(scope="module")
def found(spark):
    return brute(corpus())


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_against_brute_force(spark, found):
    assert sum(r[1] is not None for r in found) > 50 and any(r[2] != r[1] for r in found if r[1])
    assert rows(variants.grouped(clashing(frame(spark, corpus())))) == found


def test_small_blocks_and_pieces_give_the_same(spark, found, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 3)
    monkeypatch.setattr(variants, "COUNTED", 10)
    assert rows(variants.grouped(frame(spark, corpus()).repartition(7))) == found


def test_every_pair_counts_once():
    rng = random.Random(1)
    for m in (5, 6, 7, 11):
        words = {"".join(rng.choice("ab") for _ in range(m - rng.randint(0, 1))) for _ in range(60)}
        wanted = Counter(frozenset(p) for p in [(a, b) for a in words for b in words if a < b] if edits(*p) and max(map(len, p)) == m)
        met, part = Counter(), variants.PARTS
        for q in range(part):
            low, high = m * q // part, m * (q + 1) // part
            held = sorted(words, key=lambda w: (w[:low], w[len(w) - m + high :]))
            keys = [(w[:low], w[len(w) - m + high :]) for w in held]
            import numpy as np

            tile = np.array([sorted(set(keys)).index(k) for k in keys])
            none = np.zeros(len(held), int)
            for i, j in variants.near_pairs([w.encode() for w in held], tile, none, none == 0, none + q, m):
                met.update(frozenset((held[a], held[b])) for a, b in zip(i, j))
        assert met == wanted


def test_empty_table(spark):
    assert variants.grouped(frame(spark, corpus()).limit(0)).collect() == []
    assert variants.grouped(frame(spark, [(1, None), (2, "a b c")])).collect() == []
