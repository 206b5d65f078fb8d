"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import appended, bounded_batches, mixed, pieces, plus

#: What stands for a space in a piece, and a code beyond Unicode for that character in a text itself.
SPACE, PLAIN = 0x2581, 0x110000
#: Bytes of text whose lattices a worker holds at once, one text at least. Their arrays are far larger than the text.
LOT = 1 << 20


class Vocabulary:
    """Pieces with log-probabilities, as a trie over code points in sorted arrays.

    The model's merge ranks give the probabilities by Zipf's law, the power being ``theta``: the
    larger it is, the closer sampled segmentations are to the likeliest one. Bytes of characters
    that no piece covers count as the rarest piece each. Control pieces are never used.
    """

    def __init__(self, rows: list[tuple[int, str, float, bool]], theta: float):
        self.byte_ids = np.zeros(256, np.int32)
        top = max(r[0] for r in rows) + 1
        self.bytes: list[bytes] = [b""] * top
        self.rarest = -theta * float(np.log(top))
        children: dict[tuple[int, int], int] = {}
        finals, scores = [-1], [0.0]
        for number, piece, score, is_byte in rows:
            if is_byte:
                self.byte_ids[int(piece[3:5], 16)] = number
                self.bytes[number] = bytes([int(piece[3:5], 16)])
                continue
            self.bytes[number] = piece.replace(chr(SPACE), " ").encode()
            state = 0
            for c in map(ord, piece):
                state = children.setdefault((state, c), len(finals))
                if state == len(finals):
                    finals.append(-1)
                    scores.append(0.0)
            finals[state], scores[state] = number, -theta * float(np.log(2 + max(0.0, -score)))
        letters = sorted({c for _, c in children})
        self.letter = np.full(PLAIN + 1, len(letters), np.int32)  # characters by number; all others share the last one
        self.letter[letters] = np.arange(len(letters))
        self.base = len(letters) + 1
        self.root = np.full(self.base, -1, np.int32)
        for (state, c), child in children.items():
            if state == 0:
                self.root[self.letter[c]] = child
        deeper = sorted((s * self.base + int(self.letter[c]), t) for (s, c), t in children.items() if s)
        self.keys = np.array([k for k, _ in deeper] + [np.iinfo(np.int64).max], np.int64)
        self.next = np.array([t for _, t in deeper] + [0], np.int32)
        self.finals, self.scores = np.array(finals, np.int32), np.array(scores, np.float32)
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    @classmethod
    def load(cls, path: str, theta: float) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        return cls([(i, model.id_to_piece(i), model.get_score(i), model.is_byte(i)) for i in usable], theta)

    def decode(self, ids) -> str:
        """The text of these ids."""
        return b"".join(self.bytes[i] for i in ids).decode()[1:]


#: A run of spaces with the word behind it, or a line end with the word behind it.
_SEGMENT = re.compile(r" +[^ \n]*|\n[^ \n]*")


def segments(text: str) -> list[str]:
    """The text, a space before it, cut before each run of spaces and each line end.

    A piece has space marks at its front only, one or a run of them, so that no piece crosses a cut and
    the lattice of a text is a chain of lattices of its segments.
    """
    return _SEGMENT.findall(" " + text) if text else []


class Lattices:
    """Forward-filtered lattices of distinct segments, as edges sorted by the node where they end."""

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32).copy()
        sizes = np.array([len(w) for w in words], np.int32)
        stops = np.cumsum(sizes, dtype=np.int32)
        begins = stops - sizes
        of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        codes[codes == SPACE] = PLAIN
        codes[codes == 0x20] = SPACE

        # edges: walks in the trie from every place, all in step; longer ones come first
        letters, room = vocabulary.letter[codes], stops[of] - np.arange(len(codes), dtype=np.int32)
        state = vocabulary.root[letters]
        start = np.flatnonzero(state >= 0).astype(np.int32)
        state, edges, length = state[start], [], 1
        single = np.zeros(len(codes), bool)
        while len(start):
            piece = vocabulary.finals[state]
            final = np.flatnonzero(piece >= 0)
            edges.append((start[final], np.full(len(final), length, np.int32), piece[final], vocabulary.scores[state[final]]))
            if length == 1:
                single[edges[0][0]] = True
            more = np.flatnonzero(room[start] > length)
            start = start[more]
            key = state[more].astype(np.int64) * vocabulary.base + letters[start + length]
            at = np.searchsorted(vocabulary.keys, key)
            alive = np.flatnonzero(vocabulary.keys[at] == key)
            start, state = start[alive], vocabulary.next[at[alive]]
            length += 1
        bare = np.flatnonzero(~single).astype(np.int32)
        width = 1 + (codes[bare] >= 0x80) + (codes[bare] >= 0x800) + (codes[bare] >= 0x10000)
        width[codes[bare] == PLAIN] = 3
        edges.insert(0, (bare, np.ones(len(bare), np.int32), np.full(len(bare), -1, np.int32), (width * vocabulary.rarest).astype(np.float32)))
        first, length, piece, score = (np.concatenate(x[::-1]) for x in zip(*edges))

        # nodes: a segment of n characters has n + 1
        source, target = first + of[first], first + of[first] + length
        order = np.argsort(target, kind="stable")
        first, source, target, piece, score = (x[order] for x in (first, source, target, piece, score))
        forward = np.zeros(len(codes) + len(words))
        heads = np.flatnonzero(np.diff(target, prepend=-1))
        counts = np.diff(heads, append=len(target))
        depth = target[heads] - (begins + np.arange(len(words)))[of[first[heads]]]
        rank = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[rank], np.arange(1, depth.max(initial=0) + 2))
        for a, b in zip(bounds[:-1], bounds[1:]):
            group = rank[a:b]
            if not len(group):
                continue
            n = counts[group]
            lead = np.cumsum(n) - n
            e = np.repeat(heads[group] - lead, n) + np.arange(n.sum())
            value = forward[source[e]] + score[e]
            most = np.maximum.reduceat(value, lead)
            forward[target[heads[group]]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, n)), lead))

        share = np.exp(forward[source] + score - forward[target])
        upto = np.cumsum(share)
        upto -= np.repeat(upto[heads] - share[heads], counts)
        upto[heads + counts - 1] = 1.0
        self.upto, self.source = upto, source
        self.head = np.full(len(forward), -1, np.int32)
        self.head[target[heads]] = heads
        self.ends = stops + np.arange(len(words))
        self.begins = begins + np.arange(len(words))
        # ids of each edge: its piece, or the bytes of its character
        self.count = np.ones(len(piece), np.uint8)
        other = np.flatnonzero(piece < 0)
        texts = [chr(SPACE if codes[first[k]] == PLAIN else codes[first[k]]).encode("utf-8", "surrogatepass") for k in other]
        self.count[other] = [len(t) for t in texts]
        self.offset = np.cumsum(self.count, dtype=np.int32) - self.count
        self.ids = np.zeros(self.count.sum(dtype=np.int64), np.int32)
        whole = piece >= 0
        self.ids[self.offset[whole]] = piece[whole]
        for k, t in zip(other, texts):
            self.ids[self.offset[k] : self.offset[k] + len(t)] = vocabulary.byte_ids[list(t)]

    def sample(self, which: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled ids of a sequence of segments, and how many each segment has.

        From the end of each segment an edge is drawn in proportion to the probability of all paths
        through it, then one from where that begins, and so on; all segments go in step. A draw is
        a hash of the segment's seed and the step.
        """
        node, first, active, steps = self.ends[which], self.begins[which], np.arange(len(which)), []
        while len(active):
            turn = np.array([len(steps) + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            draw = (mixed(seeds[active] + turn) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = self.head[node]
            ahead = np.flatnonzero(draw >= self.upto[edge])
            while len(ahead):
                edge[ahead] += 1
                ahead = ahead[draw[ahead] >= self.upto[edge[ahead]]]
            steps.append((active, edge))
            node = self.source[edge]
            more = np.flatnonzero(node > first[active])
            active, node = active[more], node[more]
        n = np.zeros(len(which), np.int64)
        for active, _ in steps:
            n[active] += 1
        stop, path = np.cumsum(n), np.empty(n.sum(), np.int64)
        for k, (active, edge) in enumerate(steps):
            path[stop[active] - 1 - k] = edge
        width = self.count[path].astype(np.int64)
        if len(width) == width.sum():
            return self.ids[self.offset[path]], n
        lead = np.cumsum(width) - width
        ids = self.ids[np.repeat(self.offset[path] - lead, width) + np.arange(width.sum())]
        before = np.concatenate([[0], np.cumsum(width)])
        return ids, before[stop] - before[stop - n]


def encode_texts(texts: list[str], keys: list[str], vocabulary: Vocabulary, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of all texts one after another, and how many each has."""
    known: dict[str, int] = {}
    which, counts, seeds = [], np.zeros(len(texts), np.int64), []
    for k, (text, key) in enumerate(zip(texts, keys)):
        own = [known.setdefault(s, len(known)) for s in segments(text)]
        counts[k] = len(own)
        which.append(np.array(own, np.int64))
        start = np.uint64(xxhash.xxh64_intdigest(key.encode(), seed=seed))
        seeds.append(mixed(start + np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))
    if not known:
        return np.zeros(0, np.int32), counts
    ids, n = Lattices(list(known), vocabulary).sample(np.concatenate(which), np.concatenate(seeds))
    upto = np.concatenate([[0], np.cumsum(n)])
    stop = np.cumsum(counts)
    return ids, upto[stop] - upto[stop - counts]


def encoded_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, key: str, text: str, seed: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to LOT bytes of text, with the columns of ``encoded``."""
    for batch in pieces(batches, text, LOT):
        held = batch.column(text).to_pylist()
        texts = [t or "" for t in held]
        ids, counts = encode_texts(texts, [str(k) for k in batch.column(key).to_pylist()], vocabulary, seed)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        whole = b"".join(map(vocabulary.bytes.__getitem__, ids.tolist()))
        ends = np.concatenate([[0], np.cumsum(vocabulary.sizes[ids])])[offsets]
        same = [whole[a:b] == (b" " + t.encode("utf-8", "surrogatepass") if t else b"") for a, b, t in zip(ends[:-1], ends[1:], texts)]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=pa.array([t is None for t in held]))
        yield appended(batch, {"ids": lists, "n_ids": pa.array(counts), "lossless": pa.array(same, pa.bool_())})


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", theta: float = 1.0, seed: int = 1) -> DataFrame:
    """The rows with columns ids, n_ids and lossless (decoding the ids gives the text again) appended.

    Every text is segmented by forward filtering and backward sampling over the lattice of the
    model's pieces; the draws are hashes of the row's key, ``seed``, the segment and the step, so
    that a row gets the same ids wherever and whenever it is encoded. Characters without a piece
    become byte pieces. The ids of equal texts under different keys differ.

    Null texts have null ids, 0 of them; empty texts have none; null keys count as the same key.
    Columns of the new names are replaced, all others kept; an empty table gives no rows. The
    model's path is read on the driver only; its pieces travel with the function.
    """
    bounded_batches(docs.sparkSession)
    vocabulary = Vocabulary.load(model, theta)
    schema = plus(
        docs.schema, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType()), T.StructField("lossless", T.BooleanType())
    )

    return docs.mapInArrow(lambda batches: encoded_batches(batches, vocabulary, key, text, seed), schema)


def decoded(rows: DataFrame, model: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows with the text of their ids in column ``into``; null ids give null."""
    vocabulary = Vocabulary.load(model, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(ids).to_pylist()]
            yield appended(batch, {into: pa.array(texts, pa.string())})

    return rows.mapInArrow(run, plus(rows.schema, T.StructField(into, T.StringType())))


def digest(ids="ids"):
    """A SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)
