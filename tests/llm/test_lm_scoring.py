import math
from collections import Counter

import pytest
from .conftest import SF

from trailfeat.llm import lm_scoring as L
from trailfeat.llm import queries as Q


def plain_scores(docs, targets, size):
    words = {d: L.words_of(t or "") for d, t in docs.items()}
    counts = Counter(w for ws in words.values() for w in ws)
    vocabulary = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size])}
    unknown, start = len(vocabulary), len(vocabulary) + 1
    ids = {d: [vocabulary.get(w, unknown) for w in ws] for d, ws in words.items()}
    pairs = [Counter(), Counter()]
    for d, x in ids.items():
        own = Counter(zip([start, *x[:-1]], x)) if x else Counter()
        pairs[0] += own
        if d in targets:
            pairs[1] += own
    out = {}
    for d, x in ids.items():
        if not x:
            out[d] = (0, None, None, None)
            continue
        own = list(zip([start, *x[:-1]], x))
        losses, base = [], None
        for c, seen in ((pairs[0], True), (pairs[1], d in targets)):
            left = c - Counter(own) if seen else c  # the document's own counts are taken off
            one, rows = Counter(), Counter()
            for (p, w), n in left.items():
                one[w] += n
                rows[p] += n
            total = sum(one.values())
            if base is None:
                base = share = {w: (one[w] + 0.5) / (total + 0.5 * (unknown + 1)) for w in x}
            else:  # the target's words lean on the background's
                share = {w: (one[w] + L.LEAN_WORDS * base[w]) / (total + L.LEAN_WORDS) for w in x}
            losses.append(sum(-math.log((left[p, w] + L.LEAN * share[w]) / (rows[p] + L.LEAN)) for p, w in own) / len(x))
        b, t = losses
        out[d] = (len(x), t, b, t - b)
    return out


def auc(scores):
    """Probability that a labelled document's score is below another's (scores: pairs of score and label)."""
    low, high = ([s for s, y in scores if y == v] for v in (1, 0))
    return sum((a < b) + 0.5 * (a == b) for a in low for b in high) / (len(low) * len(high))


def test_random_labels_say_nothing(spark):
    """Labels dealt by chance do not part the documents: none is scored by its own counts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for seed in (0, 1):
        labels = docs.selectExpr("doc_id", f"int(pmod(xxhash64(doc_id, {seed}), 3) = 0) as quality")
        # copies of a text would pass its label on to each other
        alone = docs.where("text is not null").groupBy("text").count().where("count = 1").select("text")
        rows = L.cross_entropy_difference(docs.join(alone, "text", "left_semi"), labels).join(labels, "doc_id").where("n_tokens >= 20")
        got = auc([(r["score"], r["quality"]) for r in rows.collect()])
        assert 0.45 < got < 0.55, got


def test_labels_order_unseen_documents(spark):
    """Scores of labelled documents, each left out of its own models: good ones lean to the target."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = L.cross_entropy_difference(docs, labels).join(labels, "doc_id").where("score is not null")
    got = auc([(r["score"], r["quality"]) for r in rows.collect()])
    assert got > 0.6, got


def compare(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        n, *rest = want[r["doc_id"]]
        assert r["n_tokens"] == n
        for got, w in zip((r["target_loss"], r["background_loss"], r["score"]), rest):
            assert got == (None if w is None else pytest.approx(w, abs=2e-5))


def test_query_against_brute_force(spark, documents):
    targets = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    compare(Q.op9_cross_entropy(spark, SF).collect(), plain_scores(documents, targets, L.VOCABULARY))


def test_ties_and_small_vocabulary(spark):
    docs = {i: t for i, t in enumerate(["b a a b", "c d, E e!", "", "  ", None, "a b c d", "x y z"])}
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (0, 1), (5, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for size in (1, 3, 50):
        compare(L.cross_entropy_difference(df, labels, size).collect(), plain_scores(docs, {0, 5}, size))
    compare(L.cross_entropy_difference(df, labels.limit(0), 3).collect(), plain_scores(docs, set(), 3))


def test_target_like_documents_score_lower(spark):
    docs = [(i, ("the red the green the blue " if i % 2 else "the cat the dog the bird ") * 20) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 20, 2)], "doc_id long, quality int")
    score = {r["doc_id"]: r["score"] for r in L.cross_entropy_difference(df, labels).collect()}
    assert max(score[i] for i in range(1, 40, 2)) < 0 < min(score[i] for i in range(0, 40, 2))


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (6, 1)], "doc_id long, quality int")
    got = L.cross_entropy_difference(odd, labels).collect()
    assert len(got) == 12 and sum(r["score"] is None for r in got) == 4
    assert L.cross_entropy_difference(none, labels).collect() == []


def test_counts_flush_without_loss(spark):
    docs = spark.createDataFrame([(f"a w{i} w{i % 5}",) for i in range(200)], "text string")
    n = {bytes(r["word"]): r["n"] for r in L.word_counts(docs, held_words=7).collect()}
    assert n[b"a"] == 200 and n[b"w3"] == 41 and sum(n.values()) == 600


def test_rare_words_tell_documents_apart(spark):
    """Words beyond the most frequent 2000 keep their own losses."""
    common = " ".join(f"c{i} c{i}" for i in range(2500))
    docs = {0: common, 1: "alpha beta gamma", 2: "alpha beta gamma", 3: "delta zeta eta", 4: ""}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    rows = L.cross_entropy_difference(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()
    compare(rows, plain_scores(docs, {1}, None))
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[2] < score[3]


def test_chunks_do_not_change_scores(spark, documents):
    some = dict(list(documents.items())[:60])
    df = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1) for d in list(some)[::4]], "doc_id long, quality int")
    compare(L.cross_entropy_difference(df, labels, chunk_bytes=1).collect(), plain_scores(some, set(list(some)[::4]), None))


def test_packing_of_numbers():
    import numpy as np
    for a in ([], [0], [255, 256], [1 << 40, 3]):
        assert [x.tolist() for x in L.unpacked(L.packed(np.array(a, np.uint64), np.array([7])))] == [a, [7]]
