import re
from collections import Counter

import numpy as np
import pytest
from .conftest import SF
from pyspark.sql import functions as F

from trailfeat.llm import quality_rules as R
from trailfeat.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)) if words else 0, dup, len(inside)


TEXTS = [None, "", " \n", "a", "a b c d e f g h " * 3, "x\nx\n x\n\n\nx", "#*$ %&|<>", "Ünï cödé\x0b🙂 \x0c\r\x1cq",
         "one two three four five six seven eight nine one two three four five six seven eight", "a " * 30,
         "l1 w\nl1 w\nl2\n" * 5, " ".join(f"w{i % 37}" for i in range(5000))]


def test_statistics_by_hand(documents):
    for t in TEXTS + list(documents.values()):
        assert R.statistics(t or "")[:5] == plain(t)


def test_query_against_plain_statistics(spark, documents):
    rows = Q.op2_quality_rules(spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        want = plain(documents[r["doc_id"]])
        assert tuple(r[c] for c in R.COUNTS[:5]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_covering_finds_planted_rules_and_holds_on_other_rows():
    rng = np.random.default_rng(4)

    def rows(n):
        c = rng.integers(50, 400, (n, len(R.COUNTS)))
        c[:, 1] = 6 * c[:, 0]
        c[:, 2] = rng.integers(0, c[:, 1])
        x = R.measures(c)
        return c, (x[:, 2] > 0.7) | ((x[:, 7] > 0.2) & (x[:, 0] < 150))

    counts, bad = rows(3000)
    rules = R.learn(counts, bad, np.arange(len(counts)))
    assert 1 <= len(rules) <= R.MAX_RULES
    counts, bad = rows(3000)
    hit = np.zeros(len(bad), bool)
    for rule in rules:
        hit |= R.covered(rule, R.measures(counts))
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.03 * (~bad).sum()


def test_no_rule_from_noise_or_nothing():
    rng = np.random.default_rng(6)
    counts = rng.integers(20, 400, (600, len(R.COUNTS)))
    assert R.learn(counts, rng.random(600) < 0.3, np.arange(600)) == []
    assert R.learn(counts[:0], np.zeros(0, bool), np.zeros(0, int)) == []


def test_expression_equals_numpy(spark):
    counts = np.random.default_rng(8).integers(0, 50, (400, len(R.COUNTS)))
    rules = [(R.Condition(2, True, 0.5), R.Condition(0, False, 20.0)), (R.Condition(9, True, 1.25),)]
    df = spark.createDataFrame(counts.tolist(), list(R.COUNTS)).withColumn("i", F.monotonically_increasing_id())
    got = [r["d"] for r in df.withColumn("d", R.decision(rules)).orderBy("i").collect()]
    x = R.measures(counts)
    first, second = (R.covered(r, x) for r in rules)
    assert got == [1 if a else 2 if b else None for a, b in zip(first, second)]


def test_held_out_accuracy(spark):
    """Rules from one half of the labels against the other half, on the larger small table."""
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(2)) == 0
    rules = R.learn_from_labels(docs, labels.where(half))
    other = R.judged(docs, rules).select("row.doc_id", "base_failed", "rule").join(
        labels.where(~half).select("doc_id", "quality"), "doc_id").where("not base_failed")
    n = {(r["quality"], r["hit"]): r["n"] for r in other.groupBy("quality", F.col("rule").isNotNull().alias("hit")).agg(
        F.count("*").alias("n")).collect()}
    clean = n.get((1, True), 0) / max(1, n.get((1, True), 0) + n.get((1, False), 0))
    assert clean < 0.03


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 0, 0), (4, 1, 0), (None, 0, 0), (6, None, None), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = R.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.collect() == []  # short, blank, or repeating itself
    assert R.keep_good(none, labels).collect() == []
    assert R.learn_from_labels(odd, labels.limit(0)) == []
    assert len(R.judged(odd, []).collect()) == 12


@pytest.mark.parametrize("n", [0, 7, 8, 9])
def test_windows_at_the_edge(n):
    assert R.repeated_words([b"w"] * n) == (n if n >= 9 else 0)
