"""Quality filtering by a learned decision list over text statistics.

``text_statistics`` counts words, characters, symbols, repeated lines and
repeated 8-word windows of whole texts. ``learn`` grows a decision list from
labelled statistics by sequential covering: a rule is a conjunction of
thresholds, grown greedily by information gain on one part of the labelled rows,
pruned on the other part, and kept only if it is precise there; the rows it
covers are then set aside and the next rule is sought. ``decision`` turns the
list into one ordered Spark conditional expression. Rules describe documents to
reject; everything that no rule covers is kept, and a rule must be precise on
rows it was not grown on, so clean documents are kept.

Defined cases: a null or empty text has no words and zero statistics (and fails
the base rule); labels that are null, or disagree for a document, are left out;
without labelled rows the list is empty; repeated rows are judged alike; an
empty table gives an empty result. Extra columns are kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, texts

#: Labelled rows that the list is learned from.
SAMPLE_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVERED = 5
WINDOW_WORDS = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
          "n_digits", "n_upper", "n_stops")
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the list.

    Exact: windows are named by doubling (words, pairs, fours, eights), each
    name standing for one content.
    """
    n = len(words)
    if n <= window:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    if len(names) == n:
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)
        pair = ids[:len(ids) - step] * (ids.max() + 1) + ids[step:]
        ids = np.unique(pair, return_inverse=True)[1]
        size += step
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(twice):
        return 0
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, twice, 1)
    np.add.at(marks, twice + window, -1)
    return int((np.cumsum(marks) > 0).sum())


def statistics(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0,) * len(COUNTS)
    bare = raw.translate(None, b" \t\n\x0b\x0c\r")
    lines = [line for line in raw.split(b"\n") if line.strip()]
    spaces = len(raw) - len(bare)
    return (len(words), len(text) - spaces, len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words)),
            len(raw) - len(raw.translate(None, b"0123456789")), len(raw) - len(raw.translate(None, _UPPER)),
            sum(raw.count(c) for c in (b".", b"!", b"?")))


def with_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, n_words, ...)``: every row (its columns ``keep``, or all) as a struct, and its ``COUNTS``."""
    keep = docs.columns if keep is None else keep
    inside = keep.index(text_col) if text_col in keep else None  # the text crosses to Python once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def text_of(batch: pa.RecordBatch) -> pa.Array:
            return batch.column(1) if inside is None else batch.column(0).flatten()[inside]

        for whole in batches:
            for batch in slices(whole, 1, column=text_of(whole)):
                found = list(zip(*(statistics(t) for t in texts(text_of(batch))), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, pa.int64()) for c in found]], ["row", *COUNTS])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       *([F.col(f"`{text_col}`").alias("text")] if inside is None else []))
    kind = rows.schema["row"].dataType.simpleString()
    return map_arrow(rows, run, f"row {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


#: What conditions compare: (name, numerator, denominator or None).
MEASURES = (("words", "n_words", None), ("mean_word", "word_chars", "n_words"), ("symbols", "n_symbols", "word_chars"),
            ("dup_lines", "n_dup_lines", "n_lines"), ("repeats", "n_repeat_words", "n_words"),
            ("distinct", "n_distinct_words", "n_words"), ("digits", "n_digits", "word_chars"),
            ("upper", "n_upper", "word_chars"), ("stops", "n_stops", "n_words"), ("line_words", "n_words", "n_lines"))


@dataclass(frozen=True)
class Condition:
    measure: int
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.measure]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        _, top, bottom = MEASURES[self.measure]
        v = F.col(top).cast("double")
        v = v / F.greatest(F.col(bottom), F.lit(1)).cast("double") if bottom else v
        return v >= F.lit(self.threshold) if self.above else v <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{MEASURES[self.measure][0]} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def measures(counts: np.ndarray) -> np.ndarray:
    """The measures of rows of ``COUNTS``, by the same arithmetic as the Spark expressions."""
    by = {c: counts[:, i].astype(float) for i, c in enumerate(COUNTS)}
    return np.stack([by[t] / np.maximum(by[b], 1.0) if b else by[t] for _, t, b in MEASURES], axis=1)


def covered(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(lambda m, c: m & c.holds(x), rule, np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p or not n:
            break
        base, best = np.log2(p / (p + n)), (0.0, None)
        for f in range(x.shape[1]):
            v = x[inside, f]
            y = bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cut = np.unique(np.linspace(0, len(v) - 1, 65).astype(int))
            cut = np.unique(np.concatenate([cut, np.searchsorted(v, np.unique(v[y])[:64])]))
            pos = np.concatenate([[0], np.cumsum(y)])
            for k in cut:
                t = v[k]
                lo, hi = np.searchsorted(v, t, "left"), np.searchsorted(v, t, "right")
                for above, a, b in ((True, lo, len(v)), (False, 0, hi)):
                    cp, ct = pos[b] - pos[a], b - a
                    if cp >= MIN_COVERED and ct < len(v):
                        gain = cp * (np.log2(cp / ct) - base)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(f, above, float(t)))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(x)
    return rule


def _precision(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    m = covered(rule, x)
    return (float((m & bad).sum()) + 1) / (float(m.sum()) + 2)


def learn(counts: np.ndarray, bad: np.ndarray, order: np.ndarray, max_rules: int = MAX_RULES,
          min_precision: float = MIN_PRECISION) -> list[Rule]:
    """The decision list for rows of ``COUNTS`` with labels; ``order`` (any fixed numbers) splits grow and prune rows."""
    x = measures(counts)
    grow = order % 3 != 0
    left, rules = np.ones(len(x), bool), []
    while len(rules) < max_rules:
        g, v = left & grow, left & ~grow
        if (g & bad).sum() < MIN_COVERED:
            break
        rule = _grow(x[g], bad[g])
        # prune: the shortest prefix that is most precise on rows it was not grown on
        prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
        if not prefixes:
            break
        rule = max(prefixes, key=lambda r: (round(_precision(r, x[v], bad[v]), 6), -len(r)))
        inside = covered(rule, x)
        unseen, seen = inside & v, inside & g
        enough = (unseen & bad).sum() >= max(1, MIN_COVERED // 3) and (seen & bad).sum() >= MIN_COVERED
        exact = lambda m: (m & bad).sum() >= min_precision * m.sum()
        if not (enough and exact(unseen) and exact(seen)):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def decision(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that covers a row; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), F.lit(i)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learn_from_labels(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from ``labels (doc_id, quality)``: 0 marks documents to reject."""
    agreed = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
              .agg(F.min("quality").alias("q"), F.max("quality").alias("top")).where("q = top")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select("doc_id", "q"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(agreed), "doc_id")
    found = with_statistics(chosen, keep=["doc_id", "q"])
    # one row for each labelled document, so at most sample_rows reach the driver
    rows = found.groupBy("row.doc_id").agg(F.min(F.struct(*COUNTS, F.col("row.q").alias("q"))).alias("s")).select(
        "s.*", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("o"))
    data = np.array([tuple(r) for r in rows.orderBy("o", *COUNTS).collect()], np.int64).reshape(-1, len(COUNTS) + 2)
    # rows that the base rule rejects anyway teach nothing
    n, r = data[:, 0], data[:, COUNTS.index("n_repeat_words")]
    data = data[~((n < 20) | (100 * r > 30 * n))]
    return learn(data[:, :len(COUNTS)], data[:, -2] == 0, data[:, -1])


def judged(docs: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """``(row, counts ..., base_failed, rule, kept)`` for every row."""
    return with_statistics(docs, keep=keep).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the learned list rejects."""
    return judged(docs, learn_from_labels(docs, labels)).where("kept").select("row.*")
