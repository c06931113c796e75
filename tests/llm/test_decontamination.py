import random

import numpy as np
from .conftest import SF

from trailfeat.llm import decontamination as D
from trailfeat.llm import queries as Q


def semi_global(pattern, text):
    """Least edit distance of the pattern to any passage, by the full table."""
    row = np.arange(len(pattern) + 1)
    best = len(pattern)
    for w in text:
        new = np.empty_like(row)
        new[0] = 0
        for i, p in enumerate(pattern, 1):
            new[i] = min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != w))
        row = new
        best = min(best, int(row[-1]))
    return best


def test_myers_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(400):
        p = [rng.choice("abcd") for _ in range(rng.choice([1, 3, 9, 70]))]
        t = [rng.choice("abcde") for _ in range(rng.randint(0, 90))]
        distance, end = D.myers(p, t)
        assert distance == semi_global(p, t)
        assert min([len(p)] + [semi_global(p, t[:j]) for j in (end,)]) == distance


def test_query_against_brute_force(spark, documents):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in Q.op8_benchmark_leaks(spark, SF).collect()}
    want = {}
    for d, text in documents.items():
        words = D.normal(text).split()
        if len(words) > 1500:  # the full table over the longest texts is left to the planted cases below
            want |= {k: v for k, v in got.items() if k[0] == d}
            continue
        known = set(words)
        for i, item in items.items():
            own = D.normal(item).split()
            errors = D.budget(len(own))
            if sum(w not in known for w in own) <= errors:  # each missing word costs an edit
                distance = semi_global(own, words)
                if distance <= errors:
                    want[d, i] = distance
    assert got == want and got


def test_planted_errors_up_to_the_budget(spark):
    rng = random.Random(2)
    items = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 99)}" for _ in range(n))) for i, n in enumerate([8, 10, 25, 40, 63, 64, 65, 130])]
    docs, want = [], set()
    for i, text in items:
        words = text.split()
        for errors in range(D.budget(len(words)) + 1):
            own = list(words)
            for k in rng.sample(range(len(own)), errors):
                own[k] = rng.choice(["zz", "", f"{own[k]} yy"])
            docs.append((len(docs), "Before. " * rng.randint(0, 9) + " ".join(own).upper().replace(" ", ",\n", 1) + " after" * 5))
            want.add((len(docs) - 1, i))
    docs.append((len(docs), " ".join(w for _, t in items for w in t.split()[::-1])))
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    for r in got:
        words = D.normal(docs[r["doc_id"]][1]).split()[r["start"]:r["end"]]
        assert semi_global(D.normal(items[r["item_id"]][1]).split(), words) == r["distance"]


def test_blocks_of_items_give_the_same(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one = {tuple(r) for r in D.find_leaks(docs, bench).collect()}
    assert one == {tuple(r) for r in D.find_leaks(docs, bench, block_bytes=1500).collect()}
    clean = {r["doc_id"] for r in D.drop_contaminated(docs, bench, block_bytes=3000).collect()}
    assert clean == {r["doc_id"] for r in docs.collect()} - {r[0] for r in one}


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (3, "one two three"),
                                   (4, "One, two: three four five SIX - seven eight"), (4, "w1 w2 w3 w4 w5 w6 w7 w8 w9")],
                                  "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or 0, r["distance"]) for r in D.find_leaks(odd, items).collect())
    # items of three words must be there as they are; six of eight words are too few
    assert got == [(4, 3, 0), (4, 3, 0), (5, 3, 0), (6, 0, 0), (6, 4, 0)]
    long_only = sorted((r["doc_id"], r["item_id"] or 0) for r in D.find_leaks(odd, items, min_words=8).collect())
    assert long_only == [(6, 0), (6, 4)]
    assert D.find_leaks(none, items).collect() == [] and D.find_leaks(odd, items.limit(0)).collect() == []
    kept = D.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == 8 and D.drop_contaminated(odd, items.limit(0)).count() == 12


def test_short_items_are_found_as_they_are(spark):
    """Items of a few words, and items in scripts without spaces, are found exactly."""
    items = [(1, "Who wrote the Iliad?"), (2, "five words in this item"), (3, "日本の首都はどこですか"), (4, "水"), (5, "...")]
    docs = [(1, "q: who WROTE, the iliad? a: Homer"), (2, "who wrote an iliad"), (3, "so five words in this item, yes"),
            (4, "five words on this item"), (5, "問題:日本の首都はどこですか?東京です。"), (6, "日本の首相はどこですか"), (7, "お水をください"),
            (8, "日本の首部はどこですか 日本の首都はどこですか、です")]
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in D.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1, 0), (3, 2, 0), (5, 3, 0), (6, 3, 1), (7, 4, 0), (8, 3, 0)}
