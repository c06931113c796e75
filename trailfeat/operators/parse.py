"""Trajectory text records -> typed rows.

Record layout (one line = one trajectory)::

    labelled:    <id> <x,y,t;x,y,t;...> <ax,ay> <label>
    unlabelled:  <id> <x,y,t;x,y,t;...> <ax,ay>

Fields are split on every single space (two spaces give an empty field), the
trajectory on ``;`` with empty segments dropped, each point on ``,`` taking
x = part 0, y = part 1 and t = the *last* part. The target is the
second-last field (labelled) or the last field (unlabelled); all of its parts
must be numbers and the first two are used.

``mode="quarantine"`` (default) keeps every line and fills ``reason`` for
records the reference would have crashed on; ``mode="strict"`` fails the job
on the first such record, as the reference does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the numeric literals Python's float() accepts (decimal,
# exponent, inf/infinity/nan, surrounding whitespace).
NUMBER_RE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

def py_float(s) -> Column:
    """Cast text to double when it is a number Python would accept, else NULL."""
    s = F.col(s) if isinstance(s, str) else s
    return F.when(s.rlike(NUMBER_RE), F.trim(s).try_cast("double"))


def parse_point_list(text) -> Column:
    """``x,y,t;x,y,t;...`` -> ``array<struct<x,y,t>>`` (NULL fields for bad tokens)."""
    text = F.col(text) if isinstance(text, str) else text
    segs = F.filter(F.coalesce(F.split(text, ";", -1), F.array().cast("array<string>")),
                    lambda s: F.length(s) > 0)
    parts = F.transform(segs, lambda s: F.split(s, ",", -1))
    return F.transform(parts, lambda c: F.struct(
        py_float(F.get(c, 0)).alias("x"),
        py_float(F.get(c, 1)).alias("y"),
        py_float(F.element_at(c, -1)).alias("t")))


def parse_target(text) -> Column:
    """``ax,ay[,...]`` -> ``struct<ax, ay, ok>``; ok when >= 2 parts, all numeric."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(text, ",", -1)
    ok = ((F.size(parts) >= 2)
          & F.forall(parts, lambda p: p.rlike(NUMBER_RE)))
    return F.struct(py_float(F.get(parts, 0)).alias("ax"),
                    py_float(F.get(parts, 1)).alias("ay"),
                    F.coalesce(ok, F.lit(False)).alias("ok"))


def parse_trajectories(lines: DataFrame, labelled: bool = True, mode: str = "quarantine",
                       text_col: str = "value") -> DataFrame:
    """Text lines -> ``traj_id, points, aim, [label], reason``.

    ``reason`` is NULL for good records, else one of ``no_points``,
    ``bad_point`` and ``bad_target``. In strict mode a bad record raises.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    f = F.split(F.col(text_col), " ", -1)
    pts = parse_point_list(F.get(f, 1))
    tgt = parse_target(F.try_element_at(f, F.lit(-2 if labelled else -1)))
    df = lines.select(
        F.get(f, 0).alias("traj_id"),
        pts.alias("points"),
        tgt.alias("_tgt"),
        *([F.try_element_at(f, F.lit(-1)).alias("label")] if labelled else []),
    )
    bad_point = F.exists("points", lambda p: p["x"].isNull() | p["y"].isNull() | p["t"].isNull())
    reason = (F.when(F.size("points") == 0, F.lit("no_points"))
              .when(bad_point, F.lit("bad_point"))
              .when(~F.col("_tgt.ok"), F.lit("bad_target")))
    df = df.withColumn("reason", reason)
    if mode == "strict":
        df = df.withColumn("reason", F.when(F.col("reason").isNotNull(), F.raise_error(
            F.concat(F.lit("bad trajectory record "), F.coalesce("traj_id", F.lit("?")),
                     F.lit(": "), F.col("reason")))).cast("string"))
    out = [F.col("traj_id"), F.col("points"),
           F.struct(F.col("_tgt.ax").alias("ax"), F.col("_tgt.ay").alias("ay")).alias("aim")]
    if labelled:
        out.append(F.col("label"))
    # Emitted through a one-row generator: a later filter on ``reason`` (see
    # ``good``) then stays above it instead of being pushed below the parse
    # projection, which would evaluate the whole parse twice per line.
    return df.select(F.inline(F.array(F.struct(*out, F.col("reason")))))


def good(parsed: DataFrame) -> DataFrame:
    """Records that parsed cleanly (drops the ``reason`` column)."""
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull())


def explode_points(trajs: DataFrame, keep=("traj_id",)) -> DataFrame:
    """Array form -> long form: one row per point with its 0-based ``pos``."""
    return trajs.select(*keep, F.posexplode("points").alias("pos", "p")).select(
        *keep, F.col("pos").cast("long").alias("pos"),
        F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.t").alias("t"))


def format_points(points) -> Column:
    """Inverse of :func:`parse_point_list`: ``x,y,t;...;`` with a trailing ``;``."""
    points = F.col(points) if isinstance(points, str) else points
    body = F.array_join(F.transform(points, lambda p: F.concat_ws(
        ",", p["x"].cast("string"), p["y"].cast("string"), p["t"].cast("string"))), ";")
    return F.concat(body, F.lit(";"))
