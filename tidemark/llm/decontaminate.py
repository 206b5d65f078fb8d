"""Benchmark decontamination with word-level suffix arrays over shards of the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import appended, bounded_batches, pieces, plus, raw, staged

#: Bytes of test text searched in one pass; a larger test set is searched block after block.
BLOCK_BYTES = 1 << 20
#: Bytes of training text under one suffix array.
SHARD_BYTES = 4 << 20

#: Lower case for A-Z, and a space for each byte that is not part of a word.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)

SCAN = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.StructType([
        T.StructField("n", T.LongType()), T.StructField("doc_start", T.IntegerType()), T.StructField("item_id", T.StringType()), T.StructField("item_start", T.IntegerType())
    ])),
])
KIND = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))), ("items", pa.list_(pa.string())),
    ("longest", pa.struct([("n", pa.int64()), ("doc_start", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32())])),
])
MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_start", T.IntegerType()),
    T.StructField("doc_start", T.IntegerType()), T.StructField("n", T.IntegerType()),
]))


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class TestSet:
    """Test items as word numbers (0: between items), with the distinct windows that are searched.

    Rows of one name are one item, of several texts; equal rows count once.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        words, owners, starts, lengths, seen = [0], [-1], [], [], {}
        numbers: dict[str, int] = {}
        for name, text in sorted(set(items)):
            item = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in folded_words(text)]
            if not item:
                continue
            base, size, k = len(words), min(window, len(item)), numbers.setdefault(name, len(numbers))
            words += [*item, 0]
            owners += [k] * (len(item) + 1)
            for at in range(len(item) - size + 1):
                key = tuple(item[at : at + size])
                if key not in seen:
                    seen[key] = len(starts)
                    starts.append([])
                    lengths.append(size)
                starts[seen[key]].append(base + at)
        self.names = list(numbers)
        self.words = np.array(words, np.int32)
        self.owners = np.array(owners, np.int32)
        self.lengths = np.array(lengths, np.int32)
        self.query = np.array([s[0] for s in starts], np.int64)  # where each distinct window stands first
        self.places = np.array([p for s in starts for p in s], np.int64)
        self.place_ends = np.cumsum([len(s) for s in starts], dtype=np.int64)
        self.depth = int(self.lengths.max(initial=1))
        self.bits = max(1, len(self.vocabulary).bit_length())


def _packed(words: np.ndarray, at: np.ndarray, bits: int, most: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first words from each place in one integer, zeros from the first unknown word on; and whether none was unknown."""
    key, known = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for k in range(63 // bits):
        word = words[np.minimum(at + k, len(words) - 1)]
        known &= (word != 0) & (k < most)
        key = (key << bits) | np.where(known, word, 0)
    return key, known


def suffix_array(words: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known words, ordered by the words that follow, with the packed first words of each; the last word is 0.

    The order looks at ``depth`` words at least and stops at an unknown word (0), beyond which no
    test suffix can match. Sorting by packed words comes first, then prefix doubling of the ties.
    """
    per, end = 63 // bits, len(words)
    at = np.flatnonzero(words)
    key, known = _packed(words, at, bits, per)
    order = np.argsort(key)
    array, key, tied = at[order], key[order], known[order]
    first = np.ones(len(array), bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.zeros(end + 1, np.int64)
    rank[array] = np.maximum.accumulate(np.where(first, np.arange(len(array)), 0)) + 1
    seen = per
    while seen < depth:
        alone = first.copy()
        alone[:-1] &= first[1:]
        tied &= ~alone
        where = np.flatnonzero(tied)
        if not len(where):
            break
        places = array[where]
        group, follow = rank[places], rank[np.minimum(places + seen, end)]
        both = group * (end + 2) + follow
        order = np.argsort(both)
        array[where], both, follow = places[order], both[order], follow[order]
        head = np.ones(len(where), bool)
        head[1:] = both[1:] != both[:-1]
        first[where] = head
        rank[array[where]] = where[np.maximum.accumulate(np.where(head, np.arange(len(where)), 0))] + 1
        tied[where] = follow != 0
        seen *= 2
    return array, key


def _below(words: np.ndarray, places: np.ndarray, tests: TestSet, windows: np.ndarray, upper: bool) -> np.ndarray:
    """Whether the suffix at each place comes before its window, or with ``upper`` before all that come after it."""
    below = np.zeros(len(places), bool)
    query, length = tests.query[windows], tests.lengths[windows]
    left = np.arange(len(places))
    for k in range(tests.depth):
        ended = length[left] <= k
        below[left[ended]] = upper
        left = left[~ended]
        if not len(left):
            break
        a, b = words[np.minimum(places[left] + k, len(words) - 1)], tests.words[query[left] + k]
        below[left[a < b]] = True
        left = left[a == b]
    else:
        below[left] = upper
    return below


def search(words: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of all windows in a shard: numbers of windows, and the places where they stand."""
    array, key = suffix_array(words, tests.bits, tests.depth)
    per = 63 // tests.bits
    low, _ = _packed(tests.words, tests.query, tests.bits, tests.lengths)
    free = np.maximum(0, per - tests.lengths) * tests.bits
    lo = np.searchsorted(key, low, "left")
    hi = np.searchsorted(key, low | ((np.int64(1) << free) - 1), "right")
    windows = np.flatnonzero(lo < hi)
    lo, hi = lo[windows], hi[windows]
    long = tests.lengths[windows] > per
    bounds = []
    for upper in (False, True):
        a, b = lo.copy(), hi.copy()
        b[~long] = a[~long]
        while len(open_ := np.flatnonzero(a < b)):
            middle = (a[open_] + b[open_]) // 2
            below = _below(words, array[middle], tests, windows[open_], upper)
            a[open_[below]] = middle[below] + 1
            b[open_[~below]] = middle[~below]
        bounds.append(np.where(long, a, hi if upper else lo))
    n = bounds[1] - bounds[0]
    each = np.repeat(np.arange(len(windows)), n)
    offset = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
    return windows[each], array[bounds[0][each] + offset]


def _spread(tests: TestSet, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window all its places in the test words, as (row of ``windows``, place)."""
    ends = tests.place_ends[windows]
    begins = np.where(windows > 0, tests.place_ends[windows - 1], 0)
    n = ends - begins
    row = np.repeat(np.arange(len(windows)), n)
    return row, tests.places[np.repeat(begins, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]


def _shard(texts: list[bytes], tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a shard with a 0 after each text, and where each text starts."""
    number, parts, starts, at = tests.vocabulary.get, [], np.zeros(len(texts) + 1, np.int64), 0
    for k, text in enumerate(texts):
        found = folded_words(text)
        parts.append(np.fromiter(map(number, found, repeat(0)), np.int32, len(found)))
        parts.append(np.zeros(1, np.int32))
        at += len(found) + 1
        starts[k + 1] = at
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), starts


def _extended(words: np.ndarray, tests: TestSet, windows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, test place, words) of the longest verbatim matches: those that can't begin a word earlier."""
    row, at = _spread(tests, windows)
    places = places[row]
    first = (tests.words[at - 1] == 0) | (places == 0) | (words[places - 1] != tests.words[at - 1])
    places, at = places[first], at[first]
    n, left, k = np.zeros(len(at), np.int64), np.arange(len(at)), 0
    while len(left):
        a = words[np.minimum(places[left] + k, len(words) - 1)]
        left = left[(a == tests.words[at[left] + k]) & (a != 0)]
        k += 1
        n[left] = k
    return places, at, n


def _named(tests: TestSet, starts: np.ndarray, places: np.ndarray, at: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, dict]]:
    """Each match with its document, the item's name and both first words."""
    opens = np.flatnonzero(tests.words == 0)
    doc, begins = np.searchsorted(starts, places, "right") - 1, opens[np.searchsorted(opens, at) - 1] + 1
    for d, p, t, b, size in zip(doc.tolist(), places.tolist(), at.tolist(), begins.tolist(), n.tolist()):
        yield d, {"item_id": tests.names[tests.owners[t]], "item_start": t - b, "doc_start": p - int(starts[d]), "n": size}


def _rank(match: dict | None) -> tuple:
    return (0,) if match is None else (-match["n"], match["doc_start"], match["item_id"].encode(), match["item_start"])


def _scan(texts: list[bytes], tests: TestSet) -> list[dict]:
    words, starts = _shard(texts, tests)
    windows, places = search(words, tests) if len(tests.query) else (np.zeros(0, int), np.zeros(0, np.int64))
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + tests.lengths[windows], -1)
    covered = np.cumsum(edge) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    begin, stop = turn[::2], turn[1::2]
    of_span = np.searchsorted(starts, begin, "right") - 1
    doc = np.searchsorted(starts, places, "right") - 1
    pairs = np.unique(doc * (len(tests.query) + 1) + windows) if len(doc) else np.zeros(0, np.int64)
    row, at = _spread(tests, pairs % (len(tests.query) + 1))
    owned = np.unique(np.stack([pairs[row] // (len(tests.query) + 1), tests.owners[at]]), axis=1) if len(row) else np.zeros((2, 0), int)
    out = [{"n_words": int(starts[k + 1] - starts[k] - 1), "spans": [], "items": [], "longest": None} for k in range(len(texts))]
    for k, b, e in zip(of_span, begin, stop):
        out[k]["spans"].append({"start": int(b - starts[k]), "n": int(e - b)})
    for k, i in owned.T:
        out[k]["items"].append(tests.names[i])
    if len(places):
        found = _extended(words, tests, windows, places)
        size = found[2]
        most = np.zeros(len(texts), np.int64)
        held = np.searchsorted(starts, found[0], "right") - 1
        np.maximum.at(most, held, size)
        for k, match in _named(tests, starts, *(v[size == most[held]] for v in found)):
            out[k]["longest"] = min(match, out[k]["longest"], key=_rank)
    return out


def _longest(texts: list[bytes], tests: TestSet) -> list[list[dict]]:
    words, starts = _shard(texts, tests)
    out: list[list[dict]] = [[] for _ in texts]
    if len(tests.query):
        places, at, n = _extended(words, tests, *search(words, tests))
        order = np.lexsort((n, at, places))
        for k, match in _named(tests, starts, places[order], at[order], n[order]):
            out[k].append(match)
    return out


def _merged(a: dict, b: dict) -> dict:
    spans: list[dict] = []
    for s in sorted([*a["spans"], *b["spans"]], key=lambda s: (s["start"], s["n"])):
        if spans and s["start"] <= spans[-1]["start"] + spans[-1]["n"]:
            spans[-1]["n"] = max(spans[-1]["n"], s["start"] + s["n"] - spans[-1]["start"])
        else:
            spans.append(dict(s))
    return {"n_words": b["n_words"], "spans": spans, "items": sorted({*a["items"], *b["items"]}), "longest": min(a["longest"], b["longest"], key=_rank)}


def _blocks(tests: DataFrame, item: str, text: str, window: int) -> Iterator[TestSet]:
    """The test items in blocks of some BLOCK_BYTES, dealt by a hash; one block is on the driver at a time."""
    rows = tests.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield TestSet([(r.i, r.t.encode()) for r in part.toLocalIterator()], window)


def with_scan(docs: DataFrame, tests: DataFrame, window: int = 13, text: str = "text", item: str = "item_id", test_text: str = "text", into: str = "scan") -> DataFrame:
    """The documents, all their columns kept, with a struct ``into``: n_words, hit spans of words, ids of the items found.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased. A
    window is ``window`` consecutive words of an item, or the whole of a shorter item. Every task
    builds suffix arrays over shards of its texts; every test suffix that starts a window is
    located by binary search, and all its occurrences count. A document lies in one shard whole,
    so nothing is shuffled. ``longest`` is the document's longest verbatim match with an item (ties: the
    first in the document, then by item), null without one.

    A block travels with its function, and Spark broadcasts that. Test sets over BLOCK_BYTES are
    searched block after block over a numbered copy of the documents; a pass writes only the documents
    it has hit, and these are joined with the copy once.

    Null texts and texts without words have 0 words and no spans; null ids and null texts of items
    are left out, rows of one id are one item; repeated documents each keep their own result; a column
    named ``into`` is replaced. With no test items every document has no spans.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(into)

    def over(block: TestSet, kept: list[str] | None = None):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text, SHARD_BYTES):
                found = _scan(raw(batch, text), block)
                if kept is None:
                    yield appended(batch, {into: pa.array(found, KIND)})
                else:
                    hit = pa.array([bool(f["spans"]) for f in found], pa.bool_())
                    yield appended(batch.select(kept), {into: pa.array(found, KIND)}).filter(hit)

        return scan

    blocks = _blocks(tests, item, test_text, window)
    first = next(blocks, TestSet([], window))
    second = next(blocks, None)
    if second is None:
        return docs.mapInArrow(over(first), plus(docs.schema, T.StructField(into, SCAN)))
    row = "_" + max(["row", *docs.columns], key=len)
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    rows = numbered.select(row, text)
    hits = [staged(rows.mapInArrow(over(block, [row]), plus(rows.select(row).schema, T.StructField(into, SCAN))), "hits") for block in chain([first, second], blocks)]
    lists = reduce(DataFrame.unionAll, hits).groupBy(row).agg(F.collect_list(into).alias(into))  # one entry a block at most

    names = docs.columns

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, SHARD_BYTES):
            plain = _scan(raw(batch, text), TestSet([], window))
            whole = [reduce(_merged, h or [], p) for h, p in zip(batch.column(into).to_pylist(), plain)]
            yield appended(batch.select(names), {into: pa.array(whole, KIND)})

    return numbered.join(lists, row, "left").drop(row).mapInArrow(merged, plus(docs.schema, T.StructField(into, SCAN)))


def n_hit(into: str = "scan"):
    return F.aggregate(F.col(into)["spans"], F.lit(0).cast("long"), lambda a, s: a + s["n"])


def contaminated(into: str = "scan", share: int = 20):
    """Whether a document has hit words, and at least one in ``share`` of its words is hit."""
    return (n_hit(into) > 0) & (n_hit(into) * share >= F.col(into)["n_words"])


def remove_contaminated(docs: DataFrame, tests: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The documents without the contaminated ones; their columns stay as they are."""
    into = "_" + max(["scan", *docs.columns], key=len)  # no column of theirs
    return with_scan(docs, tests, window, into=into).where(~contaminated(into, share)).drop(into)


def longest_matches(docs: DataFrame, tests: DataFrame, window: int = 13, key: str = "doc_id") -> DataFrame:
    """One row per longest verbatim match of a test suffix: item and document, first word in either, words.

    A match has a window at least and is extended as far as the words agree; only matches that
    cannot be extended to the left are listed. Nulls and empty texts have no matches. One block of
    test items after another; the results are united.
    """
    bounded_batches(docs.sparkSession)
    schema = plus(docs.select(key).schema, T.StructField("matches", MATCHES))
    out = None
    for block in _blocks(tests, "item_id", "text", window):
        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n", pa.int32())]))
            for batch in pieces(batches, "_text", SHARD_BYTES):
                found = pa.array(_longest(raw(batch, "_text"), block), kind)
                yield pa.RecordBatch.from_arrays([batch.column(0), found], names=[key, "matches"])

        part = docs.select(F.col(key), F.col("text").alias("_text")).mapInArrow(find, schema)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = docs.select(F.col(key), F.array().cast(MATCHES).alias("matches"))
    return out.select(key, F.inline("matches"))


def digest(ids: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return hashlib.sha256(",".join(sorted(set(ids))).encode()).hexdigest()
