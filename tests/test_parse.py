import pytest
from pyspark.sql import functions as F

from trailfeat.operators.parse import (explode_points, format_points, good, parse_point_list,
                                       parse_trajectories)

CASES = [
    ("1 0,0,0;1,1,1; 5,5 1", None, 2),           # trailing separator
    ("2 0,7; 5,5 1", None, 1),                    # two-part point: t = y
    ("3 1,2,9,3; 5,5 1", None, 1),                # four-part point: t = last
    ("4 0,0,0; 5,6,7 1", None, 1),                # three-part target
    ("5  0,0,0; 5,5 1", "no_points", 0),          # double space: empty field 1
    ("6 0,a,0; 5,5 1", "bad_point", 1),           # bad token
    ("7 0,0,0; 5 1", "bad_target", 1),            # one-part target
    ("8 ; 5,5 1", "no_points", 0),                # empty trajectory
]


def _parsed(spark, lines, **kw):
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    return parse_trajectories(df, **kw)


def test_parse_cases(spark):
    rows = {r.traj_id: r for r in _parsed(spark, [c[0] for c in CASES]).collect()}
    for line, reason, npts in CASES:
        r = rows[line.split(" ")[0]]
        assert r.reason == reason, line
        assert len(r.points) == npts, line
    assert tuple(rows["2"].points[0]) == (0.0, 7.0, 7.0)
    assert tuple(rows["3"].points[0]) == (1.0, 2.0, 3.0)
    assert (rows["4"].aim.ax, rows["4"].aim.ay) == (5.0, 6.0)
    assert rows["1"].label == "1"


def test_unlabelled_target_is_last_field(spark):
    r = _parsed(spark, ["9 1,2,3;4,5,6; 7,8"], labelled=False).first()
    assert r.reason is None and (r.aim.ax, r.aim.ay) == (7.0, 8.0)
    assert "label" not in r.asDict()


def test_strict_mode_raises(spark):
    with pytest.raises(Exception, match="bad trajectory record"):
        _parsed(spark, ["6 0,a,0; 5,5 1"], mode="strict").collect()


def test_python_float_rules(spark):
    df = spark.createDataFrame([("1e3,-.5,inf;NaN,+2,1d;",)], "s string")
    pts = df.select(parse_point_list("s").alias("p")).first().p
    assert tuple(pts[0]) == (1000.0, -0.5, float("inf"))
    assert pts[1].t is None              # '1d' is not a Python float


def test_round_trip(spark):
    lines = ["a 1.5,2.25,1e-4;3,4,1234567890123; 1,2 0"]
    p = good(_parsed(spark, lines))
    text = p.select(format_points("points").alias("s")).first().s
    back = spark.createDataFrame([(text,)], "s string").select(parse_point_list("s").alias("p"))
    assert back.first().p == p.first().points
    ex = explode_points(p).collect()
    assert [r.pos for r in ex] == [0, 1]
