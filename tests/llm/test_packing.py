import random

import numpy as np
from data import clashing, frame, prose

from tidemark.llm import packing
from tidemark.llm.queries import VOCABULARY


def plain(lengths, width):
    """Best-fit decreasing by looking through all open rows; row contents as sorted sizes."""
    rows = [[width] for n in lengths for _ in range(n // width)]
    open_rows = []
    for n in sorted((n % width for n in lengths if n % width), reverse=True):
        fits = [r for r in open_rows if width - sum(r) >= n]
        if fits:
            min(fits, key=lambda r: width - sum(r)).append(n)
        else:
            open_rows.append([n])
    return sorted(sorted(r) for r in rows + open_rows)


def test_rows_against_plain_best_fit():
    rng = random.Random(5)
    for width in (1, 2, 7, 64, 100):
        for n in (0, 1, 40, 300):
            lengths = [rng.randint(0, 3 * width) for _ in range(n)]
            rows = packing.packed(lengths, width)
            assert all(sum(b - a for _, a, b in r) <= width for r in rows)
            pieces = sorted(s for r in rows for s in r)
            for k, size in enumerate(lengths):
                own = [(a, b) for t, a, b in pieces if t == k]
                assert [a for a, _ in own] == list(range(0, size, width)) and (not own or own[-1][1] == size)
            sizes = lambda rs: sorted(map(len, rs))
            assert sorted(sum(b - a for _, a, b in r) for r in rows) == sorted(map(sum, plain(lengths, width)))
            assert sizes(rows) == sizes(plain(lengths, width)) or width > 2


def test_texts_come_back(spark):
    texts = [" ".join(prose(k, random.Random(k).randint(0, 900))) for k in range(80)] + [None, "", "<|endoftext|> é 日本", "a" * 20000]
    docs = clashing(frame(spark, [*enumerate(texts), (None, "null id"), (3, texts[3])]))
    rows = packing.packed_rows(docs, VOCABULARY, width=256).collect()
    encoder = packing._encoder(packing.ranks_of(VOCABULARY))
    parts = {}
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u4")
        assert len(ids) == len(places) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids
        assert (ids[r.n_ids :] == 50256).all()
        for doc, part, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            parts.setdefault(doc, []).append((part, ids[a:b].tolist()))
    for k, text in [*enumerate(texts), (None, "null id")]:
        own = sorted(parts.get(k, []))
        if k == 3:
            assert len(own) % 2 == 0
            own = own[::2]
        assert encoder.decode([i for _, p in own for i in p]) == (text or "")


def test_empty_table(spark, tmp_path):
    assert packing.packed_rows(frame(spark, []), VOCABULARY).collect() == []
    packing.write_packed(frame(spark, [(1, "some text")]), VOCABULARY, str(tmp_path / "rows"), 16)
    assert spark.read.parquet(str(tmp_path / "rows")).first().doc_ids == [1]
