"""Words that differ by one edit, from dense tiles of padded code points; forms and roots of spelling variants."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import bounded_batches, pieces, raw, staged

#: Letters of a run; after lower-casing A-Z, runs shorter than LEAST_LETTERS can't become words.
LEAST_LETTERS, LEAST_COUNT = 5, 3
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
#: One of so many (document, run) loses a code point.
MODULUS = 97
#: Parts that a word is cut into. An edit lies in one part, so that all others must agree.
PARTS = 4
#: Rows of a block; larger buckets are dealt out as pairs of blocks.
BLOCK = 1024
#: Distinct words that a task counts before it passes them on, and rows and bytes of words that it compares at once.
COUNTED, ROWS, BYTES = 200_000, 50_000, 8 << 20


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words after the deletions, with their counts, summed over as many texts as COUNTED words allow."""
    total: Counter = Counter()

    def flush() -> pa.RecordBatch:
        found = [(w, n) for w, n in total.items() if n and len(w) >= LEAST_LETTERS]
        total.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"]
        )

    for batch in pieces(batches, "text"):
        for doc_id, text in zip(batch.column("id").to_pylist(), raw(batch, "text")):
            runs = Counter(RUN.findall(text.lower().decode()))
            before = zlib.crc32(f"{doc_id}:".encode())
            total.update(runs)
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), before)
                if h % MODULUS == 0:
                    at = h % len(run)
                    total[run] -= n
                    total[run[:at] + run[at + 1 :]] += n
            if len(total) > COUNTED:
                yield flush()
    yield flush()


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts: runs of letters with a code point deleted where the CRC-32 of id and run says so."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = rows.mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """A row per word, longer length m it may have in a pair, and part q; ``key`` hashes what must agree around the part."""
    length = F.char_length("word")
    places = F.array(*(F.struct((length + d).alias("m"), F.lit(q).alias("q")) for d in (0, 1) for q in range(PARTS)))
    low, high = (F.floor(F.col("p.m") * (F.col("p.q") + d) / PARTS).cast("int") for d in (0, 1))
    around = (F.substring("word", F.lit(1), low), F.right("word", F.col("p.m") - high))
    return vocabulary.select("word", "n", F.explode(places).alias("p")).select(
        F.col("p.m").alias("m"), F.col("p.q").alias("q"), F.xxhash64("p.m", "p.q", *around).alias("key"), "word", "n"
    )


def _tiles(keyed: DataFrame) -> DataFrame:
    """The words of each bucket in tiles: pairs (low, high) of blocks, all of which have at most BLOCK words on average."""
    sizes = keyed.groupBy("m", "q", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own: Column = F.pmod(F.xxhash64("word", F.lit("block")), F.col("blocks")).cast("int")
    return (
        keyed.join(sizes, ["m", "q", "key"]).withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("m", "q", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "word", "n")
    )


def matrix(found: list[bytes], width: int, right: bool) -> np.ndarray:
    """One row of ``width`` code points per word, padded with zeros on its other side."""
    rows = b"".join(w.rjust(width, b"\0") if right else w.ljust(width, b"\0") for w in found)
    return np.frombuffer(rows, np.uint8).reshape(len(found), width)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many code points agree from the first column on, per row."""
    differs = a != b
    return np.where(differs.any(1), differs.argmax(1), a.shape[1])


def near_pairs(found: list[bytes], tile: np.ndarray, side: np.ndarray, diagonal: np.ndarray, part: np.ndarray, m: int) -> Iterator[tuple]:
    """(i, j) of the pairs of each tile that are one edit apart and whose first matching part is that of the tile.

    ``tile`` numbers the rows' tiles in ascending order; off the diagonal the rows of ``side`` 0
    meet those of side 1, on it every row meets those after it. ``m`` is the longer length.
    """
    left, right = matrix(found, m, False), matrix(found, m, True)[:, ::-1]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    at = np.arange(len(found))
    ends = np.searchsorted(tile, tile, "right")
    turn = np.searchsorted(tile * 2 + side, tile * 2 + 1, "left")
    first = np.where(diagonal, at + 1, turn)
    followers = np.where(diagonal | (side == 0), ends - first, 0)
    bounds = np.array([[m * (q + d) // PARTS for d in (0, 1)] for q in range(PARTS)])
    upto, begin = np.cumsum(followers), 0
    most = max(1, (32 << 20) // m)
    while begin < len(at):
        stop = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + most, "right")))
        count = followers[begin:stop]
        i = np.repeat(at[begin:stop], count)
        j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[begin:stop], count)
        longer = np.maximum(lengths[i], lengths[j]) == m
        i, j = i[longer], j[longer]
        prefix, suffix = agreeing(left[i], left[j]), agreeing(right[i], right[j])
        # equal words fill the whole row; a shorter one ends at its padding
        close = (prefix + suffix >= m - 1) & (prefix < m)
        i, j, prefix, suffix = i[close], j[close], prefix[close], suffix[close]
        fits = (prefix[:, None] >= bounds[:, 0]) & (suffix[:, None] >= m - bounds[:, 1])
        keep = fits.any(1) & (fits.argmax(1) == part[i])
        yield i[keep], j[keep]
        begin = stop


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and piece of tiles: its near words, and the one of largest count that comes first."""

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        m_of = table.column("m").to_numpy()
        for m in np.unique(m_of):
            rows = table.slice(*(lambda a, b: (a, b - a))(*np.searchsorted(m_of, [m, m + 1])))
            found = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
            q, key, low, high, own = (rows.column(c).to_numpy() for c in ("q", "key", "low", "high", "own"))
            new = np.ones(len(found), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in (q, key, low, high)], axis=0)
            pairs = list(near_pairs(found, np.cumsum(new), (own != low).astype(int), low == high, q, int(m)))
            i, j = (np.concatenate([p[k] for p in pairs] + [p[1 - k] for p in pairs]) for k in (0, 1))
            if not len(i):
                continue
            n = rows.column("n").to_numpy()
            order = np.lexsort((np.array(found, object)[j], -n[j], i)) if len(i) else i
            i, j = i[order], j[order]
            who, first, near = np.unique(i, return_index=True, return_counts=True)
            text = rows.column("word").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [text.take(pa.array(who)), pa.array(near), pa.array(n[j[first]]), text.take(pa.array(j[first]))], names=["word", "near", "form_n", "form"]
            )

    held, rows, size = [], 0, 0
    for batch in batches:
        held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
        if rows < ROWS and size < BYTES:
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(c).to_numpy() for c in ("m", "q", "key", "low", "high")]
        same = np.all([x == x[-1] for x in last], axis=0)
        cut = int(np.argmax(same))  # sorted, so that the last tile begins here
        yield from compared(table.slice(0, cut))
        table = table.slice(cut).combine_chunks()
        held, rows, size = table.to_batches(), table.num_rows, table.nbytes
    if rows:
        yield from compared(pa.Table.from_batches(held))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): for each word of ``vocabulary(word, n)`` that has near words, their number and the
    one of largest n (of these, the first in code-point order).

    Two words of lengths m and m or m - 1 are one edit apart if their common prefix and suffix
    reach m - 1. The longer one is cut into PARTS parts; the edit lies in one of them, and what lies
    around it, counted from the front and from the end, agrees. So each word stands in 2 x PARTS
    buckets, and a pair counts in the first bucket that both its prefix and suffix allow. Buckets
    of more than BLOCK words are dealt out as pairs of blocks, so that no task takes a whole one.
    Inside a tile words are rows of padded code points that numpy compares; pairs are never
    written, only counts and the best of each word. Words have code points up to 255.
    """
    tiles = _tiles(_keyed(vocabulary)).repartition("m", "q", "key", "low", "high").sortWithinPartitions("m", "q", "key", "low", "high", "own")
    found = tiles.mapInArrow(_near, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("best.minus")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: where following the forms ends, by doubling the steps taken at once.

    n at least doubles from a word to its form, so that chains end and are short.
    """
    steps = staged(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def grouped(docs: DataFrame) -> DataFrame:
    """One row per word of all texts: word, n, n_near, form, form_n, root.

    Runs of letters of the whole texts, A-Z lower-cased, count as they are, but where MODULUS divides
    the CRC-32 of ``<doc_id>:<run>`` they lose the code point at that number modulo their length.
    Words are the results of LEAST_LETTERS code points and LEAST_COUNT occurrences. A word's form
    is its near word of largest n if that n is twice its own at least; the root is where the forms
    lead, the word itself if it has none.

    Null and empty texts have no words; a null id counts as an empty one. Every row counts, rows
    that repeat an id or a text too. Ties of n go to the first word in code-point order. Extra
    columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    vocabulary = staged(words(docs), "words")
    near = near_words(vocabulary)
    strong = F.col("form_n") >= 2 * F.col("n")
    found = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n"),
    )
    found = staged(found, "forms")
    led = roots(found.where("form IS NOT NULL"))
    return found.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
