"""The named trajectory format: the parser's results, whatever the splits, columns and filters."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import IsNotNull, IsNull

from conftest import SF_SMALL
from trailfeat.operators.parse import parse_trajectories
from trailfeat.sources import events as E
from trailfeat.sources import formats
from trailfeat.sources.formats import Split, _filesystem, register, split_lines

TOKENS = ["1", "+2", "-3.5", "4.", ".5", ".", "", "1e3", "1e", "-1E-2", "inf", "-Infinity", "+inf", "nan", "NaN", "-nan", "+nan",
          "1_0", "0x1", "1f", "2d", "\t7", "\x0b8", "٣", "1.5.2", "--1", "1e400", "5e-324", "é"]
ODD = ["", " ", "id", "id ", "id 1,2,3;", "id 1,2,3; 4,5", "id 1,2,3; 4,5 1", "id ; 4,5 1", "id ;;1,2,3;; 4,5 0", "id 1,2 4,5 1",
       "id 1 4,5 1", "id 1,2,3,9; 4,5,6 1", "id 1,2,3 4 1", "id 1,2,3 4,x 1", "id  1,2,3 4,5 1", "id 1,2,3 4,5,x 1", "ïd 1,2,3 4,5 ü",
       "id , 4,5 1", "id ,, 4,5 1", "id 1,2,3 , 1"] + [f"t {t},1,2;1,{t},2;1,2,{t} {t},5 1" for t in TOKENS]


def folder(lines, end="\n", name="a.txt", last=True):
    d = tempfile.mkdtemp(prefix="trailfeat-format-")
    data = (end.join(lines) + (end if last else "")).encode()
    with (gzip.open if name.endswith(".gz") else open)(os.path.join(d, name), "wb") as f:
        f.write(data)
    return d


def read(spark, path, **options):
    register(spark)
    return spark.read.format("trajectories").options(**options).load(path)


def rows(df):
    return sorted(map(repr, df.collect()))


def native(spark, lines, labelled=True):
    return rows(parse_trajectories(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3), labelled=labelled))


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_lines_as_the_parser(spark, labelled):
    want = native(spark, ODD, labelled)
    assert rows(read(spark, folder(ODD), labelled=str(labelled))) == want
    assert rows(read(spark, folder(ODD, "\r\n", last=False), labelled=str(labelled), splitBytes="7")) == want
    assert rows(read(spark, folder(ODD, name="a.txt.gz"), labelled=str(labelled))) == want


def test_every_line_lies_in_one_split():
    lines = [b"", b"abc", b"", b"de", b"f" * 30, b"", b"g"]
    for end in (b"", b"\n"):
        d = tempfile.mkdtemp(prefix="trailfeat-format-")
        path, data = os.path.join(d, "f"), b"\n".join(lines) + end
        with open(path, "wb") as f:
            f.write(data)
        for size in range(1, len(data) + 2):
            for block in (1, 3, 64):
                got = b"".join(b"".join(split_lines(Split(path, at, min(at + size, len(data))), _filesystem(path)[0], block))
                               for at in range(0, len(data), size))
                assert got == data, (size, block, end)


def test_whole_table(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="trailfeat-format-"), "in")
    lines = E.trajectory_lines(spark, SF_SMALL, corrupt=True)
    lines.write.text(d)  # _SUCCESS and checksum files lie beside the text
    want = parse_trajectories(spark.read.text(d))
    assert rows(read(spark, d, splitBytes="5000")) == rows(want)


def test_columns_and_corrupt_records(spark, monkeypatch):
    d = folder(ODD)
    register(spark)
    ids = spark.read.format("trajectories").schema("label string, traj_id string").load(d)
    assert ids.columns == ["label", "traj_id"] and ids.count() == len(ODD)
    bad = spark.read.format("trajectories").schema("_corrupt_record string, reason string").load(d).where("reason is not null")
    want = spark.createDataFrame([(x,) for x in ODD], "value string")
    n = parse_trajectories(want).where("reason is not null").count()
    got = [r["_corrupt_record"] for r in bad.collect()]
    assert len(got) == n and set(got) <= set(ODD)
    monkeypatch.setattr(formats, "numbers", None)  # no point is looked at for the ids alone
    assert set(formats.parse_block(formats.pa.array(ODD), True, ["traj_id"])) == {"traj_id", "label"}
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("trajectories").schema("speed double").load(d).collect()


def test_pushed_filters_and_strict_mode(spark):
    d = folder(ODD)
    whole = read(spark, d)
    assert rows(whole.where("reason is null and traj_id = 'id'")) == rows(whole.where((F.coalesce("reason", F.lit("")) == "") & (F.col("traj_id") == "id")))
    assert whole.where("reason is not null").count() + whole.where("reason is null").count() == len(ODD)
    reader = formats.TrajectoryReader({"path": d}, ["traj_id"])
    other = IsNotNull(("label",))
    assert list(reader.pushFilters([IsNull(("reason",)), other])) == [other]
    kept = [r for split in reader.partitions() for batch in reader.read(split) for r in batch["traj_id"].to_pylist()]
    assert len(kept) == whole.where("reason is null").count()
    with pytest.raises(Exception, match="bad trajectory record"):
        read(spark, d, mode="strict").collect()
    with pytest.raises(Exception, match="unknown mode"):
        read(spark, d, mode="loose").collect()


def test_empty_folder(spark):
    assert read(spark, tempfile.mkdtemp(prefix="trailfeat-format-")).count() == 0
