import zlib
from collections import defaultdict

import xxhash
from .conftest import SF
from pyspark.sql import functions as F

from trailfeat.llm import queries as Q
from trailfeat.llm import sharding as S


def twin(x, n, seed, rounds):
    """The permutation in plain Python."""
    a, b = S.halves(n)

    def once(x):
        left, right = x % a, x // a
        for i in range(rounds):
            m = a if i % 2 == 0 else b
            h = xxhash.xxh64_intdigest(right.to_bytes(8, "little"), xxhash.xxh64_intdigest(
                i.to_bytes(4, "little"), xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)))
            h = h - (1 << 64) if h >> 63 else h
            left, right = right, (left + h % m) % m
        return right * a + left

    x = once(x)
    while x >= n:
        x = once(x)
    return x


def test_permutation_is_a_bijection_and_equals_the_plain_version(spark):
    for n in (1, 2, 3, 7, 64, 101, 1009):
        got = [r[0] for r in spark.range(n).orderBy("id").select(S.permuted(F.col("id"), n)).collect()]
        assert sorted(got) == list(range(n))
        if n <= 101:
            assert got == [twin(x, n, S.SEED, S.ROUNDS) for x in range(n)]


def test_halves_leave_few_positions_to_walk():
    for n in (1, 2, 5, 1000, 256_410, 50_000_000_007):
        a, b = S.halves(n)
        assert a * b >= n and a * b - n <= max(64, n ** 0.5 / 8)


def test_whole_table_against_plain_numbers(spark, documents):
    rows = Q.op1_feistel_shards(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    slots = defaultdict(list)
    for r in rows:
        raw = documents[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_reproducible_whatever_the_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {tuple(r) for r in S.shard_documents(docs).select("doc_id", "shard", "slot").collect()}
    two = {tuple(r) for r in S.shard_documents(docs.repartition(7), rows_per_range=13).select(
        "doc_id", "shard", "slot").collect()}
    assert one == two


def test_hot_id_is_spread_and_numbers_have_no_gaps(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    got = S.shard_documents(docs, shards=4, rows_per_range=100).collect()
    assert sorted(r["row_number"] for r in got) == list(range(3000))
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in range(4) for i in range(750)]


def test_repeated_tasks_deal_hot_rows_alike(spark, tmp_path):
    """The plan after the salt holds no function of a row's place: computing it twice in another order gives the same."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    seen = []
    real = S.checkpointed

    def watched(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append("monotonically_increasing_id" in plan and ("Join" in plan or "Window" in plan))
        return real(df)

    S.checkpointed = watched
    try:
        S.shard_documents(docs, shards=4, rows_per_range=100).collect()
    finally:
        S.checkpointed = real
    assert seen == [False, False]


def test_odd_rows(odd, none):
    got = S.shard_documents(odd, shards=3).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in range(3) for i in range(4)]
    assert sorted(r["size"] for r in got if r["doc_id"] in (1, 2)) == [1, 1]
    whole = S.shard_rows(odd, "doc_id", "text", 3)
    assert whole.select("row.*").columns == odd.columns and whole.count() == 12
    assert S.shard_documents(none).collect() == []
