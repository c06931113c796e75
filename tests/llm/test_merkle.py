import hashlib
import zlib

import pytest

from trailfeat.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, fan=3):
    out = []
    for v in row:
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def climbed(nodes, fan):
    """The root of a list of digests, and for each leaf its path: (siblings, fold)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha(*level[k:k + fan]) for k in range(0, len(level), fan)])
    paths = []
    for i in range(len(nodes)):
        path, at = [], i
        for level in levels[:-1]:
            run = level[at // fan * fan:at // fan * fan + fan]
            path.append((run, at % fan))
            at //= fan
        paths.append(path)
    return levels[-1][0], paths


def plain(rows, fan=3):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row, by loops."""
    low = -1 << 70
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((low if r[0] is None else r[0], leaf_of(r), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: x[:2])
        trees[s] = climbed([x[1] for x in by_source[s]], fan)
    root, tops = climbed([trees[s][0] for s in order], fan) if order else (None, [])
    out = []
    for k, s in enumerate(order):
        for (_, leaf, r), path in zip(by_source[s], trees[s][1], strict=True):
            whole = path + tops[k]
            proof = sha(*[d for run, slot in whole for j, d in enumerate(run) if j != slot])
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = leaf_of((*r[:4], r[4].replace("\n", "")))
            for run, slot in whole:
                now = sha(*[now if j == slot else d for j, d in enumerate(run)])
            out.append((r[0], leaf, trees[s][0], root, proof, now, now == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in df.collect()], key=str)


DOC = "doc_id long, source string, lang string, n_chars long, text string"


def test_documents_equal_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    want = plain(rows)
    assert rows_of(merkle.verified_documents(docs)) == want
    assert {w[-1] for w in want} == {True, False}


def test_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, single leaves, extra columns with working names."""
    rows = [(1, None, "en", 3, "a\nb"), (None, None, None, None, None), (None, None, None, None, "x\ny"), (2, "", "en", 0, ""),
            (3, "é", None, 1, "é\n"), (3, "é", None, 1, "é\n"), (3, "é", None, 1, "z\nz"), (4, "Z", "de", None, None),
            (5, "a", "en", 9, "long text " * 60_000 + "\n"), (-7, "a", "en", 9, "w\nx"), (-7, "a", "en", 9, "w\nx"),
            (-7, "a", "en", 9, "w\nx"), (11, "a", "en", 9, "\n"), (12, "a", "en", 9, "\n")]
    docs = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], DOC + ", t int, run string, i long").repartition(5)
    assert rows_of(merkle.verified_documents(docs)) == plain(rows)


@pytest.mark.parametrize("fan", [2, 3, 5])
def test_fan_and_sizes(spark, fan):
    rows = [(i, f"s{k}", "en", 1, f"t{i}\n") for k in range(12) for i in range(k * k // 4 + 1)]
    docs = spark.createDataFrame(rows, DOC)
    assert rows_of(merkle.verified_documents(docs, fan)) == plain(rows, fan)


def test_one_row_and_none(spark):
    rows = [(2, "s", "en", 1, "one\n")]
    docs = spark.createDataFrame(rows, DOC)
    assert rows_of(merkle.verified_documents(docs)) == plain(rows)
    empty = merkle.verified_documents(spark.createDataFrame([], DOC))
    assert empty.collect() == []


def test_source_rows_are_dealt_over_ranges(spark):
    """A source with most of the rows is no single partition."""
    rows = spark.range(20_000).selectExpr("if(id % 10 < 9, 'hot', concat('s', id)) AS source", "id", "sha2(string(id), 256) AS leaf")
    found = merkle.numbered(rows)
    assert found.where("source = 'hot'").selectExpr("count(*) c", "count(distinct i) d", "max(i) m", "max(n) n").first() == (
        18_000, 18_000, 17_999, 18_000)
    assert found.select("t").distinct().count() == 2001
