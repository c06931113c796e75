"""Benchmark items in documents, exact or with errors, by pigeonhole pieces.

Documents and items are compared as word sequences (lower-cased runs of letters
and digits; in scripts without spaces each character is a word). An item of ``n`` words
may differ from a passage by ``floor(rate * n)`` word edits (insertions, deletions,
substitutions); one under ``EXACT_WORDS`` words must be there as it is. It is split into one
piece more than that, so every passage within the budget holds at least one
piece unchanged. An Aho-Corasick automaton finds all pieces in whole texts; each
hit is verified by Myers' bit-parallel edit distance of the whole item against
the words around the hit, and the best passage is reported.

The items are a stated query set against all rows: they are dealt to blocks of
at most ``block_bytes`` of text, so that what is broadcast has a fixed bound, and
the documents are passed over once for each block (once for ordinary benchmarks).

Defined cases: null and empty texts hold nothing; an item without words matches
nothing, and one with fewer than ``min_words`` words neither, where the caller asks for
more than one (off by default); items with the same words are all reported; repeated
rows are reported each; very long texts are searched whole, one at a time; columns other than
doc_id, text and item_id do not matter for the hits; an empty table on either side gives no hits.
``drop_contaminated`` keeps all columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, texts

ERROR_RATE = 0.2
#: Items of fewer words are matched without errors.
EXACT_WORDS = 8
MIN_WORDS = 1
BLOCK_BYTES = 16 << 20

_GAP = re.compile(r"[\W_]+")


#: Letters of scripts that are written without spaces: Thai, Lao, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def normal(text: str) -> str:
    """Lower-cased words, each with one space before and after it."""
    plain = _GAP.sub(" ", text.lower())
    if not plain.isascii() and _UNSPACED.search(plain):
        plain = " ".join(_UNSPACED.sub(r" \1 ", plain).split())
    return f" {plain.strip()} "


def budget(words: int, rate: float = ERROR_RATE) -> int:
    return int(rate * words + 1e-9) if words >= EXACT_WORDS else 0


def pieces(words: list[str], errors: int) -> list[tuple[int, list[str]]]:
    """``errors + 1`` consecutive pieces of nearly equal length: ``(offset, words)``."""
    cuts = [len(words) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def myers(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a passage of ``text`` and that passage's end (the first such)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        right_plus, right_minus = minus | (~(d | plus) & full), plus & d
        if right_plus & top:
            score += 1
        elif right_minus & top:
            score -= 1
        right_plus, right_minus = right_plus << 1 & full, right_minus << 1 & full
        plus, minus = right_minus | (~(d | right_plus) & full), right_plus & d
        if score < best:
            best, end = score, j
    return best, end


class Finder:
    """The automaton over the pieces of some items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE, min_words: int = MIN_WORDS):
        import ahocorasick

        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            words = normal(text).split()
            if len(words) < max(1, min_words):
                continue
            k = len(self.items)
            self.items.append((item, words, budget(len(words), rate)))
            for at, piece in pieces(words, self.items[k][2]):
                places.setdefault(f" {' '.join(piece)} ", []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def hits(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """``(item, distance, item words, first word, end word)`` of the best passage of each item found."""
        if self.empty or not text:
            return []
        plain = normal(text)
        found = list(self.automaton.iter(plain))
        if not found:
            return []
        words, counted, at = plain.split(), 0, 0
        best: dict[int, tuple[int, int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for end, (size, places) in found:
            # the word at which the piece begins: spaces passed so far
            start = end - size + 1
            counted, at = (counted + plain.count(" ", at, start), start) if start >= at else (plain.count(" ", 0, start), start)
            for k, offset in places:
                _, item, errors = self.items[k]
                first = counted - offset
                if (k, first) in seen:
                    continue
                seen.add((k, first))
                low = max(0, first - errors)
                window = words[low:first + len(item) + errors]
                distance, stop = myers(item, window)
                if distance <= errors:
                    # the passage's begin: the same distance backwards from its end
                    back, length = myers(item[::-1], window[:stop][::-1])
                    begin = low + stop - length if back == distance else low
                    best[k] = min(best.get(k, (distance, begin, low + stop)), (distance, begin, low + stop))
        return [(self.items[k][0], d, len(self.items[k][1]), a, b) for k, (d, a, b) in sorted(best.items())]


def blocks_of_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", rate: float = ERROR_RATE,
                    min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES) -> Iterator[Broadcast]:
    """Broadcasts of the items, each of at most about ``block_bytes`` of text."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).where(
        "text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield sc.broadcast((sorted(map(tuple, part.collect()), key=str), rate, min_words))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, item_id, distance, item_words, start, end)`` for every document and item it holds.

    ``start`` and ``end`` (exclusive) are word positions in the document, words being runs of letters and digits.
    """
    rows = docs.select("doc_id", "text")
    doc_kind, item_kind = (f.schema[0].dataType.simpleString() for f in (docs.select("doc_id"), benchmark.select("item_id")))
    schema = f"doc_id {doc_kind}, item_id {item_kind}, distance int, item_words int, start long, end long"
    names = ["doc_id", "item_id", "distance", "item_words", "start", "end"]

    def one(held: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(*held.value)
            for whole in batches:
                for batch in slices(whole, 1):
                    found = [(d, *h) for d, t in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True)
                             for h in finder.hits(t)]
                    cols = list(zip(*found, strict=True)) or [()] * 6
                    kinds = [batch.schema.field(0).type, None, pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        return map_arrow(rows, run, schema)

    found = [one(b) for b in blocks_of_items(benchmark, "item_id", "text", rate, min_words, block_bytes)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = ERROR_RATE,
                      min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    at = docs.columns.index(text_col)
    out = docs
    for held in blocks_of_items(benchmark, "item_id", "text", rate, min_words, block_bytes):
        def run(batches: Iterator[pa.RecordBatch], held: Broadcast = held) -> Iterator[pa.RecordBatch]:
            finder = Finder(*held.value)
            for whole in batches:
                for batch in slices(whole, at):
                    clean = pa.array([not finder.hits(t) for t in texts(batch.column(at))], pa.bool_())
                    yield batch.filter(clean)
        out = out.mapInArrow(run, docs.schema)
    return out
