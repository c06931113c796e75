"""Tokens that can carry personal data or secrets, their features, and span taggers.

Only *signal* tokens (with a character or change of case that the operator names, and
the tokens after its cue words) can be tagged; every other token is outside by the
definition of the model. A chain is a run of signal tokens of one line that are
parted by single spaces alone: line ends, tabs, wider gaps and the operator's own
separators (commas of tables, braces of code) end it. Chains are decoded one by one
with the same result as over the whole text, and the plain words between them cost no
Viterbi steps. The words beside a chain enter as features.

Features are computed column by column in numpy for all signal tokens of a batch of
texts, over whole tokens of any length (only the names of shapes end after 24 runs of
equal characters). A feature looks at most ``MARGIN`` words to each side, so texts above
``PIECE_CHARS`` code points are read in pieces with the same result, and only the scores of the tags are
held for the whole text.

An added span counts only if it can be of its kind (``Tagger.possible``), and touches no
other span.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .common import map_arrow, slices, texts

Span = tuple[str, int, int]
PIECE_CHARS = 1 << 20
#: Words before and after a piece that are read for the features of its first and last tokens.
MARGIN = 12
_SPACE = re.compile("[ \t-\r]+")
_OPENING, _CLOSING = "\"'`<[{", ".,;:!?\"'`>]}*%$&#|"
_SHAPE_RUNS = 24
_DIGIT, _LOWER, _UPPER, _OTHER = 48, 97, 65, 1


def _classes() -> np.ndarray:
    """Digits, lower and upper case letters as one class each, other ASCII as itself, all else as one class (at 128)."""
    out = np.arange(129)
    out[48:58], out[97:123], out[65:91], out[128] = _DIGIT, _LOWER, _UPPER, _OTHER
    return out


_CLASS = _classes()


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes of whole numbers."""
    with np.errstate(over="ignore"):
        h = values.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Cues:
    """Words (lower case, ASCII) after which the next ``reach`` tokens are signal tokens, whatever they are made of."""

    words: tuple[str, ...]
    reach: int = 2

    def __post_init__(self):
        self.pattern = re.compile(rf"(?<![a-z])(?:{'|'.join(self.words)})(?![a-z])", re.I | re.A)

    def found(self, text: str) -> list[int]:
        """Where cue words are."""
        low = text.lower()
        if not any(w in low for w in self.words):
            return []
        return [m.start() for m in self.pattern.finditer(text)]


@dataclass
class Signal:
    """Which tokens can be tagged, and what parts tokens and chains."""

    chars: str
    separators: str = ""
    follows: str = ""
    letters: bool = False  # also a change to upper case within a word, and 20 letters in a row
    cues: Cues | None = None
    is_char: np.ndarray = field(init=False, repr=False)
    is_gap: np.ndarray = field(init=False, repr=False)

    def __post_init__(self):
        self.is_char, self.is_gap = np.zeros(129, bool), np.zeros(129, bool)
        self.is_char[[ord(c) for c in self.chars]] = True
        self.is_gap[[ord(c) for c in " \t\n\x0b\x0c\r" + self.separators]] = True


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without quotes and closing punctuation at its ends."""
    while start < end and text[start] in _OPENING:
        start += 1
    while start < end and text[end - 1] in _CLOSING:
        end -= 1
    if start < end and text[end - 1] == ")" and "(" not in text[start:end]:
        end -= 1
    if start < end and text[start] == "(" and ")" not in text[start:end]:
        start += 1
    return start, end


class Tokens:
    """Signal tokens of some texts, in chains, as flat arrays.

    ``start`` and ``end`` are positions in ``text`` (the texts with a line end between
    them), ``chain`` numbers the chains, ``of`` the text of each token.
    """

    def __init__(self, batch: list[str], signal: Signal):
        self.text = "\n".join(batch)
        self.first = np.cumsum([0] + [len(t) + 1 for t in batch])
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        small = np.minimum(codes, 128).astype(np.uint8)
        gap = signal.is_gap[small]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
        self.starts, self.ends = edge[::2], edge[1::2]  # of all tokens
        self.bare_words: dict[str, int] = {}
        hit = signal.is_char[small]
        if signal.letters:
            lower, upper = (small >= 97) & (small < 123), (small >= 65) & (small < 91)
            hit[1:] |= lower[:-1] & upper[1:]
            letter = lower | upper
            turns = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]])))
            hit[turns[::2][turns[1::2] - turns[::2] >= 20]] = True
        chosen = np.zeros(len(self.starts), bool)
        chosen[np.searchsorted(self.starts, np.flatnonzero(hit & ~gap), "right") - 1] = True
        if signal.cues:
            at = np.array([p + first for first, t in zip(self.first.tolist(), batch, strict=False) for p in signal.cues.found(t)], np.int64)
            cue = np.searchsorted(self.starts, at, "right") - 1
            for step in range(1, signal.cues.reach + 1):
                near = cue[cue + step < len(self.starts)]
                chosen[near[self._text_of(near) == self._text_of(near + step)] + step] = True
        if signal.follows and len(chosen):
            lead = np.flatnonzero(chosen & np.isin(codes[self.ends - 1], [ord(c) for c in signal.follows]))
            lead = lead[lead + 1 < len(chosen)]
            chosen[lead[self._text_of(lead) == self._text_of(lead + 1)] + 1] = True
        self.index = np.flatnonzero(chosen)
        self.start, self.end = self.starts[self.index], self.ends[self.index]
        self.of = self._text_of(self.index)
        n = len(self.index)
        #: whether a token begins a chain
        self.new = np.ones(n, bool)
        self.new[1:] = (np.diff(self.index) > 1) | (self.start[1:] != self.end[:-1] + 1) | (codes[self.end[:-1]] != 32) | (np.diff(self.of) > 0)
        self.chain = np.cumsum(self.new) - 1
        self.chain_first = np.flatnonzero(self.new)
        self.chain_sizes = np.diff(np.append(self.chain_first, n))
        # the characters of the signal tokens, one after the other
        self.size = self.end - self.start
        self.at = np.cumsum(self.size) - self.size
        total = int(self.size.sum())
        self.token = np.repeat(np.arange(n), self.size)
        place = np.arange(total) - np.repeat(self.at, self.size) + np.repeat(self.start, self.size)
        self.codes = codes[place]
        self.small = np.minimum(self.codes, 128).astype(np.uint8)
        self.kinds = _CLASS[self.small]

    def __len__(self) -> int:
        return len(self.index)

    def _text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, self.starts[words], "right") - 1

    def word(self, k: int) -> str:
        return self.text[self.start[k]:self.end[k]]

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many characters of each token are marked."""
        return np.bincount(self.token[mask], minlength=len(self))

    def letters(self, chars: str) -> np.ndarray:
        return self.count(np.isin(self.codes, [ord(c) for c in chars]))

    def shapes(self) -> tuple[np.ndarray, np.ndarray]:
        """By token: a hash of its classes of characters, equal neighbours once; and one with their numbers up to 8."""
        if not len(self):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        new = np.ones(len(self.kinds), bool)
        new[1:] = (self.kinds[1:] != self.kinds[:-1]) | (self.token[1:] != self.token[:-1])
        runs = np.flatnonzero(new)
        of, kind = self.token[runs], self.kinds[runs]
        long = np.minimum(np.diff(np.append(runs, len(new))), 8)
        first = np.searchsorted(of, np.arange(len(self)))
        rank = np.arange(len(runs)) - first[of]
        out = []
        for extra in (0, long * 8192):
            h = mixed(kind * 32 + np.minimum(rank, _SHAPE_RUNS) + extra)
            h[rank >= _SHAPE_RUNS] = 0
            out.append(np.add.reduceat(h, first))
        return out[0], out[1]

    def _aside(self, step: int, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the tokens ``where``, those that have a word ``step`` words away in their text; and that word."""
        at = self.index[where] + step
        inside = (at >= 0) & (at < len(self.starts))
        where, at = where[inside], at[inside]
        same = self._text_of(at) == self.of[where]
        return where[same], at[same]

    def beside(self, step: int, where: np.ndarray) -> np.ndarray:
        """For the tokens ``where``, the number of the word ``step`` words away (0: none), lower-cased and bare; -1 for others."""
        out = np.full(len(self), -1, np.int64)
        out[where] = 0
        tokens, at = self._aside(step, where)
        wanted, back = np.unique(at, return_inverse=True)
        known, names = self.bare_words, []
        for s, e in zip(self.starts[wanted].tolist(), self.ends[wanted].tolist(), strict=True):
            word = self.text[s:e]
            got = known.get(word)
            if got is None:
                got = known[word] = 1 + zlib.crc32(word.lower().strip(_OPENING + _CLOSING + "=()").encode("utf-8", "surrogatepass"))
            names.append(got)
        out[tokens] = np.array(names, np.int64)[back] if names else 0
        return out

    def matching(self, pattern: re.Pattern[str]) -> np.ndarray:
        """By word of the texts: whether a match begins in it."""
        out = np.zeros(len(self.starts), bool)
        at = np.array([m.start() for m in pattern.finditer(self.text)], np.int64)
        out[np.searchsorted(self.starts, at, "right") - 1] = True
        return out

    def marked(self, words: np.ndarray, step: int = 0) -> np.ndarray:
        """For each token, whether the word ``step`` words away in its text is marked."""
        out = np.zeros(len(self), bool)
        tokens, at = self._aside(step, np.arange(len(self)))
        out[tokens] = words[at]
        return out

    def around(self, values: np.ndarray, reach: int = 8) -> np.ndarray:
        """Sums of values over the tokens of the chain up to ``reach`` tokens away."""
        total = np.concatenate([[0], np.cumsum(values)])
        first = self.chain_first[self.chain] if len(self) else self.chain
        k = np.arange(len(self))
        return total[np.minimum(first + self.chain_sizes[self.chain], k + reach + 1)] - total[np.maximum(first, k - reach)]

    def neighbours(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the tokens before and after in the chain; 1 and 2 where there is none."""
        before, after = np.full(len(self), 1, np.uint64), np.full(len(self), 2, np.uint64)
        same = self.chain[1:] == self.chain[:-1]
        before[1:][same] = values[:-1][same]
        after[:-1][same] = values[1:][same]
        return before, after

    def ends_of_chains(self) -> tuple[np.ndarray, np.ndarray]:
        first, last = np.zeros(len(self), bool), np.zeros(len(self), bool)
        first[self.chain_first] = True
        last[self.chain_first + self.chain_sizes - 1] = True
        return first, last


def feature_ids(columns: list[np.ndarray]) -> np.ndarray:
    """Ids of the values of each column: rows of tokens, one id for each column; 0 is never used."""
    ids = [1 + (mixed(c.astype(np.int64).view(np.uint64) if c.dtype != np.uint64 else c, k) % np.uint64(crf.FEATURE_ROWS - 1)).astype(np.int32)
           for k, c in enumerate(columns)]
    return np.stack(ids, axis=1).astype(np.int32)


def pieces(text: str, limit: int) -> list[tuple[int, int, int, int]]:
    """``(from, own, to, until)``: read ``text[from:until]``; the tokens that start in ``own .. to`` are the piece's own.

    Cuts are at white space, and what is read besides holds ``MARGIN`` words at least, more than any feature looks at.
    """
    cuts = [0]
    while len(text) - cuts[-1] > limit:
        m = _SPACE.search(text, cuts[-1] + limit)
        if not m:
            break
        cuts.append(m.end())
    cuts.append(len(text))
    out = []
    for own, to in zip(cuts[:-1], cuts[1:], strict=True):
        size = 2000
        while own - size > 0 and len(text[own - size:own].split()) < MARGIN + 2:
            size *= 2
        left = max(0, own - size)
        size = 2000
        while to + size < len(text) and len(text[to:to + size].split()) < MARGIN + 2:
            size *= 2
        out.append((left, own, to, min(len(text), to + size)))
    return out


@dataclass
class _Scored:
    """Signal tokens of a batch with the scores of their tags."""

    of: np.ndarray
    start: np.ndarray
    end: np.ndarray
    new: np.ndarray
    scores: np.ndarray


@dataclass
class Tagger:
    """What an operator adds to the chain: kinds, base rules, signal tokens, token features, and what a span can be."""

    kinds: tuple[str, ...]
    base: Callable[[str], list[Span]]
    signal: Signal
    features: Callable[[Tokens, np.ndarray], list[np.ndarray]]
    possible: Callable[[str, str], bool]
    file_feature: Callable[[str], int] = lambda text: 0

    def encoded(self, batch: list[str], about: list[int] | None = None) -> tuple[Tokens, np.ndarray]:
        """The signal tokens of some texts and their features; ``about``: the files' features."""
        tokens = Tokens(batch, self.signal)
        files = np.array([self.file_feature(t) for t in batch] if about is None else about, np.int64)
        if not len(tokens):
            return tokens, np.zeros((0, 1), np.int32)
        return tokens, feature_ids(self.features(tokens, files[tokens.of]))

    def labelled(self, text: str, spans: list[Span]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Training sequences of a text with known spans."""
        tokens, x = self.encoded([text])
        y = np.zeros(len(tokens), np.int64)
        for kind, s, e in spans:
            inside = np.flatnonzero((tokens.start < e) & (s < tokens.end))
            y[inside] = 2 + 2 * self.kinds.index(kind)
            firsts = inside[np.diff(tokens.chain[inside], prepend=-1) != 0]
            y[firsts] -= 1
        cuts = tokens.chain_first[1:]
        return (np.split(x, cuts), np.split(y, cuts)) if len(tokens) else ([], [])

    def _scored(self, model: crf.Crf, batch: list[str], about: list[int] | None = None) -> _Scored:
        tokens, x = self.encoded(batch, about)
        shift = tokens.first[tokens.of]
        scores = crf.emissions(model, x) if len(tokens) else np.zeros((0, model.weights.shape[1]), np.float32)
        return _Scored(tokens.of, tokens.start - shift, tokens.end - shift, tokens.new, scores)

    def _long(self, model: crf.Crf, text: str) -> _Scored:
        """The tokens of one very long text, read in pieces."""
        about, parts = self.file_feature(text), []
        for left, own, to, until in pieces(text, PIECE_CHARS):
            part = self._scored(model, [text[left:until]], [about])
            keep = (part.start + left >= own) & (part.start + left < to)
            parts.append(_Scored(part.of[keep], part.start[keep] + left, part.end[keep] + left, part.new[keep], part.scores[keep]))
        return _Scored(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("of", "start", "end", "new", "scores")))

    def _found(self, model: crf.Crf, texts_: list[str], scored: _Scored) -> list[list[Span]]:
        """Spans that the chains tag, by text."""
        out: list[list[Span]] = [[] for _ in texts_]
        first = np.flatnonzero(scored.new)
        tags = crf.decode_chains(model, scored.scores, np.diff(np.append(first, len(scored.new))))
        for i in np.flatnonzero(tags % 2 == 1).tolist():
            inside, j = tags[i] + 1, i
            while j + 1 < len(tags) and tags[j + 1] == inside and not scored.new[j + 1]:
                j += 1
            text, kind = texts_[scored.of[i]], self.kinds[(tags[i] - 1) // 2]
            s, e = trimmed(text, int(scored.start[i]), int(scored.end[j]))
            if s < e and self.possible(kind, text[s:e]):
                out[scored.of[i]].append((kind, s, e))
        return out

    def _tagged(self, model: crf.Crf, batch: list[str]) -> list[list[Span]]:
        """The spans of each text; small texts together, very long ones in pieces."""
        out: list[list[Span]] = [[] for _ in batch]
        held: list[int] = []
        chars = 0

        def together() -> None:
            own = [batch[k] for k in held]
            for k, found in zip(held, self._found(model, own, self._scored(model, own)), strict=True):
                out[k] = found
            held.clear()

        for k, text in enumerate(batch):
            if len(text) > PIECE_CHARS:
                out[k] = self._found(model, [text], self._long(model, text))[0]
                continue
            if chars + len(text) > PIECE_CHARS:
                together()
                chars = 0
            held.append(k)
            chars += len(text)
        together()
        return out

    def spans(self, model: crf.Crf, batch: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and added spans of each text; an added span touches no other span."""
        out = []
        for text, tagged in zip(batch, self._tagged(model, batch), strict=True):
            known = self.base(text)
            added = []
            taken = sorted((s, e) for _, s, e in known)
            at = reach = 0
            for kind, s, e in tagged:
                while at < len(taken) and taken[at][0] < e:
                    reach = max(reach, taken[at][1])
                    at += 1
                if reach <= s:
                    added.append((kind, s, e))
                    reach = e
            out.append((known, added))
        return out


def sampled_ids(docs: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` document ids that come first by hash (a bounded sample, the same on every run)."""
    return docs.select("doc_id").where("doc_id is not null").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(tagger: Tagger, docs: DataFrame, gold: list[tuple[str, list[Span]]], sample_docs: int,
        sample_runs: int, longest_run: int = 24) -> crf.Crf:
    """Train on the labelled table ``gold`` and on base spans in a bounded sample of documents.

    ``sample_docs`` documents are looked at, and ``sample_runs`` of their token
    runs with a base span (up to ``longest_run`` tokens each) reach the driver.
    What the base rules do not find there is open: it may be what the model is for.
    """
    pairs = [tagger.labelled(t, s) for t, s in gold]
    xs = [x for own, _ in pairs for x in own]
    ys = [y for _, own in pairs for y in own]
    slots = xs[0].shape[1] if xs else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    known = tagger.base(text)
                    for i, (x, y) in enumerate(zip(*tagger.labelled(text, known), strict=True) if known else ()):
                        if y.any():
                            first = max(0, int(np.flatnonzero(y)[0]) - longest_run // 2)
                            cut = slice(first, first + longest_run)
                            rows.append((doc, i, x[cut].ravel().tolist(), np.where(y[cut] > 0, y[cut], crf.OPEN).tolist()))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                cols = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 ["doc", "run", "x", "y"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(sampled_ids(docs, sample_docs)), "doc_id", "left_semi")
    found = map_arrow(chosen.select(F.col("doc_id").cast("long"), "text"), run,
                      "doc long, run long, x array<int>, y array<long>")
    first = found.orderBy(F.xxhash64("doc", "run"), "doc", "run", "x").limit(sample_runs)
    for r in first.orderBy("doc", "run", "x").collect():
        xs.append(np.array(r["x"], np.int32).reshape(-1, slots))
        ys.append(np.array(r["y"], np.int64))
    return crf.train(xs, ys, list(tagger.kinds))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def span_rows(docs: DataFrame, tagger: Tagger, model: crf.Crf, order: Callable[[Span], tuple], id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id``, base spans by kind, the digest of the base spans and all spans, for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    counts = [f"n_{k}" for k in tagger.kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                found = tagger.spans(held.value, texts(batch.column(1)))
                base = [sorted(b, key=order) for b, _ in found]
                cols = [batch.column(0)]
                cols += [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in tagger.kinds]
                cols.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]))
                cols.append(pa.array([joined(sorted(b + a, key=order)) for b, a in found], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *counts, "base_sha256", "spans"])

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, " + "".join(f"{c} long, " for c in counts) + "base_sha256 string, spans string"
    return map_arrow(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), run, schema)


def masked(docs: DataFrame, tagger: Tagger, model: crf.Crf, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<kind>``; a null text stays null.

    Overlapping spans are replaced together, under the kind of the first.
    ``n_chars``, where present as an integer, is set to the new length.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at, 4 << 20):
                old = batch.column(at).to_pylist()
                found = tagger.spans(held.value, [t or "" for t in old])
                new = [None if t is None else replaced(t, b + a) for t, (b, a) in zip(old, found, strict=True)]
                cols = list(batch.columns)
                cols[at] = pa.array(new, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(text_col).cast(kind)))
    return out


def replaced(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out += [text[end:s], f"<{kind}>"]
        end = max(end, e)
    return "".join(out) + text[end:]
