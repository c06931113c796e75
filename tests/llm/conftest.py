import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents table as a dict, for brute-force twins."""
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, extra columns with working names."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (4, "one two three four five six", "x"),
            (4, "one two three four five six", "x"), (5, "one two three four five six", None), (None, "lone text", "x"),
            (None, None, None), (6, long_text, "x"), (7, "Ünïcödé wörds – ﬁne text 🙂", "x"), (8, "a\n\nb  c \n", "x"),
            (4, "another text under a used id", "y")]
    return spark.createDataFrame([(i, t, s, s, 1, 2, "r") for i, t, s in rows],
                                 "doc_id long, text string, source string, shard string, slot int, h int, row string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
