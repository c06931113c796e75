import io
import json
import random
import zlib

import numpy as np
import pytest
from .conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailfeat.llm import bpe
from trailfeat.llm import queries as Q
from trailfeat.llm import token_ids as T
from trailfeat.llm.bpe import Encoder

ODD_TEXTS = ["", " a", "a ", "a  b", "a\tb c", "<|endoftext|> x <|endoftext|>y", "it's we'll I'M don't'", "é́ x Å x́",
             "İstanbul ΣΑΣ ς", "x²y 10³ ½ a_b __ c1d2", "naïve—dash … “q”  nb \x1c z \x85 q", "日本語 テキスト", "\n", "a\nb\n",
             "🙂 👍🏽ok", "ª º µ ß ÿ Ð ×÷", "a \n b", "l'été d'd 's''s", "ŉ ǆ Ⅷ ﬁ", "\xad soft\xadhy", "tab\t\tx", "_a_ 'RE 'Re"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(documents, name):
    enc = Encoder(Q.tokenizer_path(name), cache_words=500)  # the cache starts anew many times
    lib = Tokenizer.from_file(Q.tokenizer_path(name))
    for t in ODD_TEXTS + list(documents.values()):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_random_strings(name, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 25)  # texts are cut many times
    pool = [" ", " ", "\n", "\t", "a", "B", "the", "cat sat", "'s", "'LL", "é", "İ", "Σς", "²", "½", "́", "\x1c", "\x85", "\xa0", "日本",
            "🙂", "<|", "<|endoftext|>", "_", "-", "...", "12", "x1y", "\x00", "ﬁ", "ª", "\xad", "don't", "ÀÉ"]
    rng = random.Random(11)
    enc = Encoder(Q.tokenizer_path(name), cache_words=50)
    lib = Tokenizer.from_file(Q.tokenizer_path(name))
    assert enc.engine is not None
    for _ in range(3000):
        t = "".join(rng.choices(pool, k=rng.randrange(1, 40)))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_unknown_files_go_through_the_library(tmp_path):
    """A file with another normalizer or merges in another order gets the library's ids."""
    path = Q.tokenizer_path("byte_bpe_50k.json")
    file = json.load(open(path))
    assert bpe.form_of(file) == "bytes"
    changed = {**file, "normalizer": {"type": "Lowercase"}}
    assert bpe.form_of(changed) is None
    merges = list(file["model"]["merges"])
    merges[0], merges[1] = merges[1], merges[0]
    swapped = {**file, "model": {**file["model"], "merges": merges}}
    for k, other in enumerate((changed, swapped)):
        own = tmp_path / f"{k}.json"
        own.write_text(json.dumps(other))
        enc, lib = Encoder(str(own)), Tokenizer.from_file(str(own))
        assert enc.engine is None
        for t in ODD_TEXTS:
            assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("width", [1, 3, 8, 15, 16, 17, 20, 31, 32])
def test_packing_round_trip(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 7, 8, 9, 1000, 70_001):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        data = T.pack(ids, width)
        assert len(data) == -(-n * width // 8) and (T.unpack(data, width, n) == ids).all()


def test_random_access_reads_ranges():
    rng = np.random.default_rng(5)
    lengths = [3, 0, 50, 1, 200]
    ids = rng.integers(0, 49_408, sum(lengths)).astype(np.uint32)
    out, at = io.BytesIO(), 0
    w = T.FileWriter(out, 17, bucket=3, block_ids=16)
    for d, n in zip([4, None, 9, 9, 12], lengths):
        w.add(d, ids[at:at + n])
        at += n
    w.close()
    f = T.TokenFile(out.getvalue())
    assert f.docs.tolist() == [4, 0, 9, 9, 12] and f.null.tolist() == [False, True, False, False, False]
    for a, b in [(0, 0), (0, 1), (15, 17), (40, 254), (0, 254), (253, 254)]:
        assert (f.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        T.TokenFile(out.getvalue()[:-1])
    assert f.starts.tolist() == [0, 3, 3, 53, 54, 254]


def test_query_against_the_library(spark, documents):
    lib = Tokenizer.from_file(Q.tokenizer_path("word_bpe_49k.json"))
    got = {r["doc_id"]: tuple(r)[1:] for r in Q.op10_token_files(spark, SF).collect()}
    start = 0
    for d in sorted(documents):
        ids = lib.encode(documents[d], add_special_tokens=False).ids + [2]
        assert got.pop(d) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


@pytest.mark.parametrize("bounds", [[], [5], [1, 5, 5, 5, 9], list(range(0, 40, 3)), [-7] * 8 + [2] * 9])
def test_bounds_by_binary_search(spark, bounds):
    df = spark.range(-10, 45).withColumnRenamed("id", "doc_id")
    got = df.select("doc_id", T.bounds_below(bounds, "<").alias("b"), T.bounds_below(bounds, "<=").alias("u")).collect()
    for r in got:
        assert (r["b"], r["u"]) == (sum(x < r["doc_id"] for x in bounds), sum(x <= r["doc_id"] for x in bounds))


def test_hot_ids_small_files_and_order(spark, tmp_path):
    docs = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("doc_id"),
                                   F.concat(F.lit("word "), F.col("id") % 4).alias("text"))
    folder = f"file://{tmp_path}/ids"
    files = T.write_token_files(docs, folder, Q.tokenizer_path("word_bpe_49k.json"), 49_408, 2, file_ids=40, bucket_rows=30)
    rows = T.read_token_files(spark, folder).join(files.select("file", "before"), "file").selectExpr(
        "doc_id", "before + start as start", "n_tokens").orderBy("start").collect()
    assert len(rows) == 400 and files.count() > 13
    at, last = 0, None
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        assert last is None or r["doc_id"] is not None and r["doc_id"] >= last
        last = r["doc_id"]
    assert sum(r["doc_id"] is None for r in rows) == 134


def test_odd_rows(odd, none):
    got = T.token_file_rows(odd, Q.tokenizer_path("word_bpe_49k.json"), 49_408, 2).collect()
    assert len(got) == 12 and sorted(r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)) == [1, 1, 1]
    assert T.token_file_rows(none, Q.tokenizer_path("word_bpe_49k.json"), 49_408, 2).collect() == []
