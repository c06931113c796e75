import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from .conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailfeat.llm import packing as P
from trailfeat.llm import queries as Q


def plain_bfd(lengths, window):
    """Rooms of the windows that one-at-a-time best-fit decreasing leaves, sorted."""
    rooms = []
    for s in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= s
        else:
            rooms.append(window - s)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_one_at_a_time_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 7, 16, 30, 100])
    top = rng.randint(1, window)
    lengths = [rng.randint(1, top) for _ in range(rng.choice([0, 1, 5, 60, 300]))]
    counts = Counter(lengths)
    used, ranks = defaultdict(list), defaultdict(set)
    for length, first, n, window0, per, at in P.plan(counts, window):
        for j in range(n):
            used[window0 + j // per].append((at + (j % per) * length, length))
            assert first + j not in ranks[length]
            ranks[length].add(first + j)
    assert {s: set(range(c)) for s, c in counts.items()} == dict(ranks)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(window - sum(n for _, n in p) for p in used.values()) == plain_bfd(lengths, window)


def check(rows, ids):
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        part = np.array(own[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(part)
        covered[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for group in (covered, sequences):
        for places in group.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
    assert all(sum(n for _, n in p) == len(ids[d]) for d, p in covered.items()) and covered.keys() == ids.keys()
    assert all(sum(n for _, n in p) <= 2048 for p in sequences.values())
    return sequences


def test_query_against_the_library(spark, documents):
    tok = Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json"))
    ids = {d: tok.encode(t, add_special_tokens=False).ids + [1] for d, t in documents.items()}
    sequences = check(Q.op6_best_fit_packing(spark, SF).collect(), ids)
    assert sum(map(len, ids.values())) > 0.97 * 2048 * len(sequences)


def test_small_lanes_give_whole_results(spark):
    pieces = spark.range(2000).select("id", (F.col("id") % 7 + F.when(F.col("id") % 3 == 0, 40).otherwise(1)).alias("length"),
                                      F.lit("x").alias("offset"))
    got = P.pack_pieces(pieces.drop("offset"), 64, lane_bytes=1000).collect()
    assert sorted(r["id"] for r in got) == list(range(2000))
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 64


def test_odd_rows(odd, none):
    path = Q.tokenizer_path("byte_bpe_50k.json")
    rows = P.pack_documents(odd, path, 1).collect()
    assert len({r["sequence_id"] for r in rows if r["length"] == 2048}) == sum(r["length"] == 2048 for r in rows) > 10
    assert sorted(r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2)) == [1, 1]
    assert sum(r["doc_id"] == 4 for r in rows) == 3 and sum(r["doc_id"] is None for r in rows) == 2
    assert P.pack_documents(none, path, 1).collect() == []
    with_ids = P.pack_documents(odd.where("doc_id = 7"), path, 1, id_bytes=4).collect()
    assert len(with_ids[0]["ids"]) == 4 * with_ids[0]["length"]
    narrow = P.pack_documents(odd.where("doc_id = 7"), path, 1, id_bytes=2).collect()
    assert np.frombuffer(narrow[0]["ids"], "<u2").tolist() == np.frombuffer(with_ids[0]["ids"], "<u4").tolist()
