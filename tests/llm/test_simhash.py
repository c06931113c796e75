import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from .conftest import SF
from pyspark.sql import functions as F

from trailfeat.llm import queries as Q
from trailfeat.llm import simhash as M
from trailfeat.llm.components import components


def plain_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(fps, max_bits=4):
    """Smallest position reachable, by comparing all."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_query_against_brute_force(spark, documents):
    ids = sorted(documents)
    fps = [plain_fingerprint(documents[i]) for i in ids]
    roots = plain_components(fps)
    want = {(i, f"{fp:016x}", ids[r]) for i, fp, r in zip(ids, fps, roots)}
    assert {tuple(r) for r in Q.op4_simhash(spark, SF).collect()} == want


@pytest.mark.parametrize("blocks,group_rows", [(5, 4096), (6, 4096), (6, 5), (7, 3), (8, 4096)])
def test_links_connect_what_close_pairs_connect(spark, blocks, group_rows):
    rng = random.Random(blocks)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(12):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = M.fingerprint_links(df, blocks=blocks, group_rows=group_rows).collect()
    at = {signed(f): i for i, f in enumerate(fps)}
    assert all(bin(fps[at[r["u"]]] ^ fps[at[r["v"]]]).count("1") <= 64 for r in links)
    found = {(r["node"], r["root"]) for r in components(spark.createDataFrame(links, "u long, v long")).collect()} if links else set()
    root = dict(found)
    got = [root.get(signed(f), signed(f)) for f in fps]
    want = plain_components(fps)
    groups = lambda xs: {tuple(i for i, y in enumerate(xs) if y == x) for x in xs}
    assert groups(got) == groups(want)


def test_spanning_links_of_a_large_group_are_few():
    rng = np.random.default_rng(1)
    members = np.unique(rng.integers(0, 8, 3000) | (1 << 40))
    links = M.spanning_links(members.astype(np.int64), 4)
    assert len(links) == len(members) - 1


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, j) for j in range(501, 560)] + [(7, 7), (600, 601), (601, 600)]
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(201)} | {(i, 500) for i in range(500, 560)} | {(600, 600), (601, 600)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_odd_rows_and_keeping_one(odd, none):
    got = M.near_duplicates(odd).collect()
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    assert len(got) == 12 and by[(1, 0)] == by[(2, 0)] == by[(3, 0)] == by[(None, 0)] == 1
    kept = M.keep_one(odd)
    rows = kept.collect()
    assert kept.columns == odd.columns
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in rows)
    assert [t[0] for t in texts] == [-1, 1, 4, 4, 6, 7, 8]  # 5 repeats 4; the twin of 4 goes; the lone null id stays
    assert M.keep_one(none).collect() == [] and M.near_duplicates(none).collect() == []


def test_hot_copies_stay_once(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same words again and again"))
                                   .otherwise(F.concat(F.lit("own text "), F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    assert M.keep_one(docs).count() == 401
