"""Cross-entropy difference scoring with matched n-gram models.

Two bigram models of the same form, smoothing and vocabulary are counted over
the corpus: the background over all documents, the target over the documents
that are labelled as wanted. A document's score is its mean loss per token under
the target model minus that under the background model; low scores read like
the target. A document's own counts are taken off both models before it is scored
(leave one out), so its label alone does not move its score.

The shared vocabulary is every word of all documents, and every bigram counts;
nothing of it reaches the driver or is broadcast. Documents are written once as
*chunks* (some MB of text, words numbered within the chunk). Each chunk sends
its own word counts to buckets of words, which add them up, number the words and
answer each chunk about the words it sent; bigram counts go to buckets of bigrams
and back in the same way. A chunk then has the sums for all it holds and scores
its documents. A word or bigram is one entry per chunk however often it occurs,
so a frequent one weighs no more in its bucket than the number of chunks, and
the number of buckets grows with the corpus.

``vocabulary`` keeps the most frequent words only (ties by word) and makes all
others one unknown token; it is off unless it is given.

Words are runs of letters and digits of the lower-cased (A-Z) UTF-8 text; bytes
outside ASCII count as letters.

Defined cases: a text without words (null, empty) has 0 tokens and null losses
and score; a null doc_id is never a target; labels that are null or not 1 mark
no target, and without any target the target model is the background's words without
their context; repeated rows
count as often as they occur (each takes off its own counts alone); a very long text
is a chunk of its own; columns other than doc_id, text and quality do not matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_arrow, slices, texts

#: Words that the models keep; None is all of them.
VOCABULARY: int | None = None
#: Words that a task holds before it passes its counts on.
HELD_WORDS = 300_000
#: Text of a chunk (one document at least).
CHUNK_BYTES = 4 << 20
#: Least number of buckets, and tokens of the corpus for each further one.
WORD_BUCKETS, WORD_BUCKET_TOKENS = 256, 16_000_000
PAIR_BUCKETS, PAIR_BUCKET_TOKENS = 512, 4_000_000
#: Pseudo-count by which a bigram distribution leans on the unigram one.
LEAN = 20.0
#: Pseudo-count by which the target's unigram distribution leans on the background's.
LEAN_WORDS = 1000.0
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_TOKENS, _MARKS, _WORDS, _PAIRS = range(4)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def word_counts(docs: DataFrame, held_words: int = HELD_WORDS) -> DataFrame:
    """``(word, n)`` over all documents (column ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                             ["word", "n"])
            held.clear()
            return got

        for whole in batches:
            for batch in slices(whole, 0, 4 << 20):
                for text in texts(batch.column(0)):
                    held.update(words_of(text))
                if len(held) > held_words:
                    yield out()
        yield out()

    return map_arrow(docs.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 on, compressed: steps of ascending ones, the narrowest type, byte by byte."""
    out = []
    for a in arrays:
        a = np.asarray(a, np.uint64)
        ascending = len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        steps = np.diff(a, prepend=np.uint64(0)) if ascending else a
        narrow = steps.astype(np.min_scalar_type(int(steps.max())) if len(a) else np.uint8)
        out += [np.array([len(a), narrow.itemsize, ascending], "<u8").tobytes(),
                narrow.view(np.uint8).reshape(-1, narrow.itemsize).T.tobytes()]
    plain = b"".join(out)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    out, at = [], 0
    while at < len(plain):
        size, width, ascending = np.frombuffer(plain, "<u8", 3, at).tolist()
        planes = np.frombuffer(plain, np.uint8, size * width, at + 24).reshape(width, size)
        steps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()
        out.append(np.cumsum(steps, dtype=np.uint64) if ascending else steps)
        at += 24 + size * width
    return out


def _bytes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b" ".join(words), np.uint8)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(docs: DataFrame, known: set[bytes] | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, ids, tokens, data)`` of ``docs (doc_id, text)``; ``data`` packs the document sizes, tokens and words.

    A word that is not ``known`` is the empty one.
    """
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = held.value if held else None
        nr = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in slices(whole, 1, chunk_bytes):
                local: dict[bytes, int] = {}
                sizes, tokens = [], []
                for text in texts(batch.column(1)):
                    words = words_of(text)
                    if kept is not None:
                        words = [w if w in kept else b"" for w in words]
                    sizes.append(len(words))
                    tokens.append(np.fromiter((local.setdefault(w, len(local)) for w in words), np.uint32, len(words)))
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
                data = packed(np.array(sizes), np.concatenate(tokens), _bytes(list(local)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nr], pa.int64()), ids, pa.array([sum(sizes)], pa.int64()), pa.array([data], pa.binary())],
                    ["chunk", "ids", "tokens", "data"])
                nr += 1

    return map_arrow(docs.select("doc_id", "text"), run, f"chunk long, ids array<{kind}>, tokens long, data binary")


class _Chunk:
    """A chunk from its rows ``(kind, bucket, data, marks)``."""

    def __init__(self, rows: pa.Table):
        self.answers: dict[int, list[bytes]] = {_WORDS: [], _PAIRS: []}
        marks, kinds = [], rows.column("kind").to_pylist()
        for at in np.lexsort((rows.column("bucket").to_numpy(), kinds)):
            if kinds[at] == _TOKENS:
                self.at, data = int(at), rows.column("data")[at].as_py()
            elif kinds[at] == _MARKS:
                marks = rows.column("marks")[at].as_py()
            else:
                self.answers[kinds[at]].append(rows.column("data")[at].as_py())
        sizes, tokens, words = unpacked(data)
        self.sizes, self.tokens = sizes.astype(np.int64), tokens.astype(np.int64)
        self.words = words.astype(np.uint8).tobytes().split(b" ") if len(tokens) else []
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.target = np.zeros(len(self.sizes), bool)
        self.target[marks] = True
        some = self.sizes > 0
        self.last = np.cumsum(self.sizes)[some] - 1
        self.some = some

    def word_stats(self) -> list[np.ndarray]:
        """By word: occurrences, those in target documents, those at the end of a document, and those in targets."""
        x, on = self.tokens, self.target[self.doc]
        last = x[self.last]
        return [np.bincount(v, minlength=len(self.words)) for v in (x, x[on], last, last[self.target[self.some]])]

    def word_buckets(self, buckets: int) -> np.ndarray:
        return np.fromiter((zlib.crc32(w) % buckets for w in self.words), np.int64, len(self.words))

    def answered(self, kind: int, of: np.ndarray) -> list[np.ndarray]:
        """The answers, in the order of what was asked; ``of``: its buckets."""
        order = np.argsort(of, kind="stable")
        got = [unpacked(a) for a in self.answers[kind]]
        out = []
        for parts in zip(*got, strict=True):
            whole = np.empty(len(of), np.uint64)
            whole[order] = np.concatenate(parts)
            out.append(whole)
        return out

    def renumbered(self, ids: np.ndarray, *stats: np.ndarray) -> list[np.ndarray]:
        """Number the words by their ids, so that bigrams are in the order of ids; the ids and stats follow."""
        order = np.argsort(ids)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.tokens = place[self.tokens]
        return [v[order] for v in (ids, *stats)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams ``before`` (0 is the start, else 1 + the word) and ``word``, and each token's bigram."""
        width = len(self.words)
        before = np.concatenate([[0], self.tokens[:-1] + 1])
        before[(self.last + 1)[:-1]] = 0
        cells, which = np.unique(before * width + self.tokens, return_inverse=True)
        return cells // width, cells % width, which


def _pair_buckets(before: np.ndarray, word: np.ndarray, buckets: int) -> np.ndarray:
    h = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _asked(chunk: int, of: np.ndarray, columns: list) -> pa.Table:
    """Rows ``(bucket, chunk, data)``: the columns cut by bucket."""
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
    buckets, data = of[order[cuts]], []
    for part in np.split(order, cuts[1:]) if len(cuts) else []:
        data.append(packed(*(_bytes([c[i] for i in part]) if isinstance(c, list) else c[part] for c in columns)))
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "chunk": pa.array([chunk] * len(data), pa.int64()),
                     "data": pa.array(data, pa.binary())})


def _summed(which: np.ndarray, size: int, column: np.ndarray) -> np.ndarray:
    # exact below 2^53
    return np.bincount(which, weights=column, minlength=size).astype(np.uint64)


def _ask_words(rows: DataFrame, buckets: int) -> DataFrame:
    def ask(group: pa.Table) -> pa.Table:
        c = _Chunk(group)
        return _asked(group.column("chunk")[0].as_py(), c.word_buckets(buckets), [c.words, *c.word_stats()])

    def answer(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        asked = [unpacked(d) for d in group.column("data").to_pylist()]
        lists = [a[0].astype(np.uint8).tobytes().split(b" ") for a in asked]
        coded = pa.array([w for ws in lists for w in ws], pa.binary()).dictionary_encode()
        which, size = coded.indices.to_numpy(), len(coded.dictionary)
        n, t, e, et = (_summed(which, size, np.concatenate([a[i] for a in asked])) for i in range(1, 5))
        data, at = [], 0
        for ws in lists:
            own = which[at:at + len(ws)]
            at += len(ws)
            # 0 is the start
            data.append(packed(1 + own.astype(np.int64) * buckets + bucket, n[own], t[own], (n - e)[own], (t - et)[own]))
        known = size - (b"" in coded.dictionary.to_pylist())
        sums = {"known": known, "n": n.sum(), "t": t.sum(), "e": e.sum(), "et": et.sum()}
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "data": pa.array(data, pa.binary()),
                         **{k: pa.array([int(v)] + [0] * (len(data) - 1), pa.int64()) for k, v in sums.items()}})

    return rows.groupBy("chunk").applyInArrow(ask, "bucket int, chunk long, data binary").groupBy("bucket").applyInArrow(
        answer, "chunk long, bucket int, data binary, known long, n long, t long, e long, et long")


def _ask_pairs(rows: DataFrame, word_buckets: int, buckets: int) -> DataFrame:
    def ask(group: pa.Table) -> pa.Table:
        c = _Chunk(group)
        if not len(c.tokens):
            return _asked(0, np.zeros(0, np.int64), [])
        ids, = c.renumbered(c.answered(_WORDS, c.word_buckets(word_buckets))[0])
        before, word, which = c.pairs()
        n = np.bincount(which)
        t = np.bincount(which[c.target[c.doc]], minlength=len(n))
        before, word = np.append(np.uint64(0), ids)[before], ids[word]
        return _asked(group.column("chunk")[0].as_py(), _pair_buckets(before, word, buckets), [before, word, n, t])

    def answer(group: pa.Table) -> pa.Table:
        asked = [unpacked(d) for d in group.column("data").to_pylist()]
        before, word, n, t = (np.concatenate([a[i] for a in asked]) for i in range(4))
        if max(before.max(), word.max()) < 1 << 32:
            _, which = np.unique(before.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), return_inverse=True)
        else:
            _, which = np.unique(np.stack([before, word], 1), axis=0, return_inverse=True)
            which = which.ravel()
        size = int(which.max()) + 1
        n, t = _summed(which, size, n), _summed(which, size, t)
        data, at = [], 0
        for a in asked:
            own = which[at:at + len(a[0])]
            at += len(own)
            data.append(packed(n[own], t[own]))
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                         "data": pa.array(data, pa.binary())})

    return rows.groupBy("chunk").applyInArrow(ask, "bucket int, chunk long, data binary").groupBy("bucket").applyInArrow(
        answer, "chunk long, bucket int, data binary")


def _within(doc: np.ndarray, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``doc * width + value``, how often each occurs, and which of them each entry is."""
    keys, which, count = np.unique(doc * width + values, return_inverse=True, return_counts=True)
    return keys, count, which


def _own(doc: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each entry, the sum of weights over the entries of the same document and value."""
    _, _, which = _within(doc, values, int(values.max()) + 1)
    return np.bincount(which, weights=weights)[which]


def _scores(rows: DataFrame, kind: str, sums: dict[str, int], word_buckets: int, pair_buckets: int,
            lean: float = LEAN, lean_words: float = LEAN_WORDS) -> DataFrame:
    def score(group: pa.Table) -> pa.Table:
        c = _Chunk(group)
        losses = [None, None]
        if len(c.tokens):
            ids, *stats = c.renumbered(*c.answered(_WORDS, c.word_buckets(word_buckets)))
            before, word, which = c.pairs()
            cells = c.answered(_PAIRS, _pair_buckets(np.append(np.uint64(0), ids)[before], ids[word], pair_buckets))
            # what a document itself adds to the counts of its bigrams, of the words before them, and of their words
            pair, own_pair, _ = _within(c.doc, which, len(before))
            doc = pair // len(before)
            before, word, cell = before[pair % len(before)], word[pair % len(before)], pair % len(before)
            own_before, own_word = _own(doc, before, own_pair), _own(doc, word, own_pair)
            for k, (total, starts) in enumerate(((sums["n"], sums["e"]), (sums["t"], sums["et"]))):
                # leave one out: a document is scored by models that have not seen it
                seen = np.ones(len(doc)) if k == 0 else c.target[doc].astype(np.float64)
                rest = total - seen * c.sizes[doc]
                count = stats[k][word] - seen * own_word
                # words that the target lacks are as rare to it as to the background, not rarer by its size
                one = (count + 0.5) / (rest + 0.5 * (sums["known"] + 1)) if k == 0 else (count + lean_words * one) / (rest + lean_words)
                rows_of = np.append(np.uint64(starts), stats[2 + k]).astype(np.float64)[before] - seen * own_before
                loss = -np.log((cells[k][cell] - seen * own_pair + lean * one) / (rows_of + lean))
                with np.errstate(invalid="ignore"):
                    losses[k] = np.bincount(doc, weights=own_pair * loss, minlength=len(c.sizes)) / c.sizes
        background, target = ([None] * len(c.sizes) if v is None else v for v in losses)
        blank = ~c.some
        if len(c.tokens):
            cols = [pa.array(v, pa.float64(), mask=blank) for v in (target, background, target - background)]
        else:
            cols = [pa.nulls(len(c.sizes), pa.float64())] * 3
        return pa.table([group.column("ids")[c.at].values, pa.array(c.sizes, pa.int64()), *cols],
                        names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return rows.groupBy("chunk").applyInArrow(
        score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, vocabulary: int | None = VOCABULARY,
                             chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, n_tokens, target_loss, background_loss, score)`` for every row of ``docs``.

    ``labels (doc_id, quality)``: quality 1 marks the target documents.
    """
    known = None
    if vocabulary is not None:
        # at most `vocabulary` words reach the driver
        known = {bytes(r["word"]) for r in word_counts(docs).orderBy(F.desc("n"), "word").limit(vocabulary).collect()}
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    held = _stored(chunks(docs, known, chunk_bytes), "lm-chunks")
    tokens = held.agg(F.sum("tokens")).first()[0] or 0
    word_buckets = max(WORD_BUCKETS, tokens // WORD_BUCKET_TOKENS)
    pair_buckets = max(PAIR_BUCKETS, tokens // PAIR_BUCKET_TOKENS)
    # The labels grow with the corpus: a shuffled join of the ids at every size.
    wanted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("wanted")).distinct()
    placed = held.select("chunk", F.posexplode("ids").alias("place", "id"))
    marks = placed.join(wanted.hint("shuffle_hash"), F.col("id") == F.col("wanted"), "left_semi").groupBy("chunk").agg(
        F.collect_list("place").alias("marks"))  # at most the documents of the chunk

    def rows(df: DataFrame, of: int) -> DataFrame:
        empty = {"bucket": "int", "data": "binary", "ids": f"array<{kind}>", "marks": "array<int>"}
        return df.select("chunk", F.lit(of).alias("kind"),
                         *[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in empty.items()])

    text = rows(held.withColumn("bucket", F.lit(0)), _TOKENS)
    given = text.unionByName(rows(marks.withColumn("bucket", F.lit(0)), _MARKS))
    words = _stored(_ask_words(given.drop("ids"), word_buckets), "lm-words")
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("known", "n", "t", "e", "et")]).first().asDict()
    numbered = given.unionByName(rows(words, _WORDS))
    pairs = _ask_pairs(numbered.drop("ids"), word_buckets, pair_buckets)
    return _scores(numbered.unionByName(rows(pairs, _PAIRS)), kind, sums, word_buckets, pair_buckets)
