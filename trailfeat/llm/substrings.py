"""Repeated passages: windows of words that also start in an earlier document, found by level-wise doubling.

A window of ``2 L`` words can repeat only where both its halves do. So windows of
``first`` words are looked at in all documents, those that occur in more than one
document are candidates, and candidates alone are extended to twice the length (the
last level stops at ``length``, its halves overlapping), until ``length`` is reached
or no candidates survive. Every window of ``length`` words whose word sequence also
starts in a document with a smaller id covers its words, and covered words go.

Documents are written once as *chunks* (some MB of text, words numbered within the
chunk). On each level a chunk sends the distinct names (hashes) of its candidate
windows to buckets by ranges of names, in packets; a bucket answers each packet with one bit
for each name. Names below the last level have just the bits that keep chance
matches rare for the size of the corpus, as a candidate too many costs work and no
result; on the last level a name has 96 bits and travels with its smallest document.
However often a window is repeated, it is one entry for each chunk, so a passage that all
documents share weighs no more in its bucket than the number of chunks. Bucket and
chunk sizes are bounded, their numbers grow with the corpus.

Words are maximal runs outside ``\\x20 \\x09-\\x0D``, unchanged.

Defined cases: a null or empty text has no words; a document shorter than a window
keeps all of them; a null id has no place in the order, so such a document neither
loses words nor makes others lose any; rows that repeat an id are one document in the
order and do not cover each other; an empty table gives an empty result. A very
long text is a chunk of its own. Columns other than id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_arrow, slices, texts
from .lm_scoring import packed, unpacked

LENGTH = 13
FIRST = 4
CHUNK_BYTES = 8 << 20
#: Windows of one bucket, about, and bits of a name beyond those that count the windows.
BUCKET_WINDOWS = 1_000_000
SPARE_BITS = 8
_TEXT, _STATE, _ANSWER = range(3)
_MULTIPLIERS = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB))


def levels(length: int = LENGTH, first: int = FIRST) -> list[int]:
    """Window lengths from ``first`` on, each twice the one before, up to ``length``."""
    out = [min(first, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def _joined(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """The names of windows from those of their halves."""
    one, two = (np.uint64(m) for m in _MULTIPLIERS[seed])
    with np.errstate(over="ignore"):
        h = (a ^ (b * one + (b >> np.uint64(31)))) * two
        h = (h ^ (h >> np.uint64(29))) * one
    return h ^ (h >> np.uint64(32))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, words, ids, data)`` of ``docs (doc_id, text)``; ``data`` packs the document sizes, tokens and words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nr = TaskContext.get().partitionId() << 33
        local: dict[bytes, int] = {}
        ids, sizes, tokens, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            data = packed(np.array(sizes), np.concatenate(tokens), np.frombuffer(b" ".join(local), np.uint8))
            return pa.RecordBatch.from_arrays(
                [pa.array([nr], pa.int64()), pa.array([sum(sizes)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([data], pa.binary())], ["chunk", "words", "ids", "data"])

        for whole in batches:
            for batch in slices(whole, 1, 1 << 20):
                for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    plain = text.encode()
                    if ids and held + len(plain) > chunk_bytes:
                        yield out()
                        nr += 1
                        local, ids, sizes, tokens, held = {}, [], [], [], 0
                    words = plain.split()
                    ids.append(doc)
                    sizes.append(len(words))
                    number = local.setdefault
                    tokens.append(np.fromiter((number(w, len(local)) for w in words), np.uint32, len(words)))
                    held += len(plain)
        if ids:
            yield out()

    return map_arrow(docs, run, "chunk long, words long, ids array<long>, data binary")


class Chunk:
    """A chunk's documents, and its candidate windows of one length."""

    def __init__(self, ids: list, data: bytes):
        sizes, tokens, words = unpacked(data)
        self.ids, self.sizes, self.tokens = ids, sizes.astype(np.int64), tokens.astype(np.int64)
        self.words = words.astype(np.uint8).tobytes().split(b" ") if len(tokens) else []
        self.ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        known = np.array([d is not None for d in ids], bool)
        #: words from each on to the end of its document; none where the id is null
        self.room = np.where(known[self.doc], self.ends[self.doc] - np.arange(len(self.tokens)), 0)

    def numbers(self) -> np.ndarray:
        """The ids as numbers; windows of a null one are never looked at."""
        return np.array([0 if d is None else d for d in self.ids], np.int64)

    def starts(self, length: int) -> np.ndarray:
        """Where windows of this length start."""
        return np.flatnonzero(self.room >= length)

    def names(self, length: int, seed: int = 0) -> np.ndarray:
        """The name of the window that starts at each word (meaningless where it would leave the document)."""
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        name, now = hashes[self.tokens], 1
        while now < length:
            step = min(now, length - now)
            name[:-step] = _joined(name[:-step], name[step:], seed) if step < len(name) else name[:-step]
            now += step
        return name


class Level:
    """What the windows of a chunk that start at ``starts`` ask, and what the answers make of them."""

    def __init__(self, chunk: Chunk, starts: np.ndarray, length: int, last: bool, bits: int, buckets: int):
        self.chunk, self.last = chunk, last
        value = chunk.names(length)[starts]
        if last:
            other = chunk.names(length, 1)[starts] >> np.uint64(32)
            order = np.lexsort((other, value))
            value, other = value[order], other[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (other[1:] != other[:-1])
            self.other = other[new]
            bucket = value[new] >> np.uint64(32)
            self.bucket = (bucket * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        else:
            value = value >> np.uint64(64 - bits)
            order = np.argsort(value, kind="stable")
            value = value[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            top = value[new] >> np.uint64(max(0, bits - 32))
            self.bucket = (top * np.uint64(buckets) >> np.uint64(min(bits, 32))).astype(np.int64)
        self.value = value[new]
        self.starts = starts[order]
        self.which = np.cumsum(new) - 1  # the name of each window
        self.first = np.flatnonzero(new)
        if last and len(starts):
            #: by name, the smallest document of the chunk that has it
            self.least = np.minimum.reduceat(chunk.numbers()[chunk.doc[self.starts]], self.first)

    def asked(self) -> list[tuple[int, bytes]]:
        """``(bucket, packet)``: names in order; with their smallest document, or whether several documents have them."""
        if not len(self.value):
            return []
        if self.last:  # documents as unsigned numbers of the same order
            more = [self.other, self.least.view(np.uint64) ^ np.uint64(1 << 63)]
        else:
            docs = self.chunk.doc[self.starts]
            more = [(np.minimum.reduceat(docs, self.first) != np.maximum.reduceat(docs, self.first)).astype(np.uint64)]
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        return [(int(self.bucket[a]), packed(self.value[a:b], *[m[a:b] for m in more]))
                for a, b in zip(cuts, [*cuts[1:], len(self.value)], strict=True)]

    def marked(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """By name: the answers, which come bucket by bucket."""
        bits = [np.unpackbits(np.frombuffer(b, np.uint8)) for _, b in sorted(answers)]
        counts = np.unique(self.bucket, return_counts=True)[1]
        return np.concatenate([b[:n] for b, n in zip(bits, counts, strict=True)] or [np.zeros(0, np.uint8)]).astype(bool)


def _answered(last: bool):
    def answer(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() == _STATE:  # on its way to the next level
            return group.select(["chunk", "kind", "bucket", "data"]).append_column("hits", pa.array([0] * len(group), pa.int64()))
        asked = [unpacked(d) for d in group.column("data").to_pylist()]
        value = np.concatenate([a[0] for a in asked])
        if last:
            other, least = (np.concatenate([a[i] for a in asked]) for i in (1, 2))
            order = np.lexsort((other, value))
            new = np.ones(len(value), bool)
            new[1:] = (value[order][1:] != value[order][:-1]) | (other[order][1:] != other[order][:-1])
            which = np.empty(len(value), np.int64)
            which[order] = np.cumsum(new) - 1
            smallest = np.minimum.reduceat(least[order], np.flatnonzero(new))
            yes = smallest[which] < least
        else:
            _, which, count = np.unique(value, return_inverse=True, return_counts=True)
            several = np.bincount(which, weights=np.concatenate([a[1] for a in asked]), minlength=len(count)) > 0
            yes = ((count > 1) | several)[which]
        cuts = np.cumsum([0] + [len(a[0]) for a in asked])
        parts = [yes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"chunk": group.column("chunk"), "kind": group.column("kind"), "bucket": group.column("bucket"),
                         "data": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
                         "hits": pa.array([int(p.sum()) for p in parts], pa.int64())})
    return answer


class Passage:
    """How the levels are asked: window lengths, bits of a name, and each level's number of buckets so far."""

    def __init__(self, lengths: list[int], bits: int):
        self.lengths, self.bits, self.buckets = lengths, bits, []

    def level(self, at: int, chunk: Chunk, starts: np.ndarray | None) -> Level:
        if at == 0:
            starts = chunk.starts(self.lengths[0])
        return Level(chunk, starts, self.lengths[at], at == len(self.lengths) - 1, self.bits, self.buckets[at])


class _Group:
    """The rows of one chunk: its text, the starts of its candidates, and answers about them."""

    def __init__(self, rows: pa.Table):
        self.number = rows.column("chunk")[0].as_py()
        self.answers, self.starts = [], None
        for kind, bucket, ids, data in zip(*(rows.column(c).to_pylist() for c in ("kind", "bucket", "ids", "data")), strict=True):
            if kind == _TEXT:
                self.chunk = Chunk(ids, data)
            elif kind == _STATE:
                self.starts = unpacked(data)[0].astype(np.int64)
            else:
                self.answers.append((bucket, data))

    def candidates(self, at: int, how: Passage) -> np.ndarray | None:
        """Starts of the windows of level ``at`` whose halves both came back from the level below."""
        if at == 0:
            return None
        below, length = how.level(at - 1, self.chunk, self.starts), how.lengths[at]
        found = np.zeros(len(self.chunk.tokens) + length, bool)
        found[below.starts] = below.marked(self.answers)[below.which]
        starts = self.chunk.starts(length)
        return starts[found[starts] & found[starts + length - how.lengths[at - 1]]]


_GIVEN = "chunk long, kind int, bucket int, ids array<long>, data binary"


def _given(df: DataFrame, kind: int | None = None) -> DataFrame:
    cols = {"kind": "int", "bucket": "int", "ids": "array<long>", "data": "binary"}
    named = df if kind is None else df.withColumn("kind", F.lit(kind))
    return named.select("chunk", *[(F.col(c) if c in named.columns else F.lit(None)).cast(k).alias(c) for c, k in cols.items()])


def _asks(rows: DataFrame, at: int, how: Passage) -> DataFrame:
    """Packets of level ``at``, and the state that their answers will need (under buckets below zero)."""
    def ask(group: pa.Table) -> pa.Table:
        given = _Group(group)
        starts = given.candidates(at, how)
        out = [(_ANSWER, b, d) for b, d in how.level(at, given.chunk, starts).asked()]
        if at:
            out.append((_STATE, -1 - given.number % 65_521, packed(starts)))
        kinds, of, data = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"chunk": pa.array([given.number] * len(out), pa.int64()), "kind": pa.array(kinds, pa.int32()),
                         "bucket": pa.array(of, pa.int32()), "data": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # the first level needs no answers
        for batch in batches:
            for k in range(batch.num_rows):
                yield from ask(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    kind = "chunk long, kind int, bucket int, data binary"
    return rows.groupBy("chunk").applyInArrow(ask, kind) if at else map_arrow(rows, run, kind)


def _kept(rows: DataFrame, how: Passage) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every document, from the answers of the last level."""
    last, length = len(how.lengths) - 1, how.lengths[-1]

    def keep(group: pa.Table) -> pa.Table:
        given = _Group(group)
        c = given.chunk
        edge = np.zeros(len(c.tokens) + length + 1, np.int64)
        if given.answers:
            level = how.level(last, c, given.starts)
            covers = level.marked(given.answers)[level.which] | (c.numbers()[c.doc[level.starts]] > level.least[level.which])
            np.add.at(edge, level.starts[covers], 1)
            np.add.at(edge, level.starts[covers] + length, -1)
        gone = np.cumsum(edge)[:len(c.tokens)] > 0
        removed = np.bincount(c.doc, weights=gone, minlength=len(c.ids)).astype(np.int64)
        words, kept = c.words, []
        for k, end in enumerate(c.ends.tolist()):
            own = slice(end - int(c.sizes[k]), end)
            left = c.tokens[own][~gone[own]] if removed[k] else c.tokens[own]
            kept.append(b" ".join([words[t] for t in left.tolist()]))
        return pa.table({"doc_id": pa.array(c.ids, pa.int64()), "n_words": pa.array(c.sizes, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return rows.groupBy("chunk").applyInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")


def drop_repeats(docs: DataFrame, length: int = LENGTH, first: int = FIRST, chunk_bytes: int = CHUNK_BYTES,
                 bucket_windows: int = BUCKET_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for every row; ``kept`` joins the words that stay by one space."""
    if not 1 <= first <= length:
        raise ValueError("first must be between 1 and length")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    held = _stored(chunks(rows, chunk_bytes), "substring-chunks")
    text = _given(held, _TEXT)
    total = held.agg(F.sum("words")).first()[0] or 0
    how = Passage(levels(length, first), min(64, max(1, total).bit_length() + SPARE_BITS))
    windows, given = total, text
    for at in range(len(how.lengths)):
        how.buckets.append(max(1, -(-windows // bucket_windows), min(64, windows // 1000)))
        last = at == len(how.lengths) - 1
        answered = _stored(_asks(given, at, how).groupBy("bucket").applyInArrow(
            _answered(last), "chunk long, kind int, bucket int, data binary, hits long"), f"substring-answers-{at}")
        given = text.unionByName(_given(answered))
        windows = answered.agg(F.sum("hits")).first()[0] or 0
        if not (last or windows):  # no candidates survive
            given = text
            break
    return _kept(given, how)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of ``drop_repeats``: ``(doc_id, n_words, n_removed, kept_sha256)``."""
    return drop_repeats(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
