"""The trajectory text as a named format: ``spark.read.format("trajectories").load(path)``.

``register(spark)`` makes the name known. Files are cut into splits of ``splitBytes``
(compressed files are one split each), a split is read in blocks and parsed as whole
Arrow columns, so memory does not depend on the size of a file. Results are those of
``operators.parse.parse_trajectories``, which needs no Python worker where the lines
come from Spark's text source.

Options: ``labelled`` (true), ``mode`` (``quarantine``: bad records come as rows with
their ``reason``; ``strict``: they fail the read), ``splitBytes`` (64 MB). Only the
columns of the given schema are computed, so ``.schema("traj_id string")`` parses no
points; ``_corrupt_record`` may be asked for there and holds the line of a bad record.
Tests of ``reason`` for null are done while reading (``register`` turns the session's
filter pushdown for such formats on). Lines end with ``\\n`` or ``\\r\\n``; files whose names start with ``_`` or
``.`` are not read; a path without files gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, IsNotNull, IsNull

SPLIT_BYTES = 64 << 20
BLOCK = 4 << 20
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
CORRUPT = "_corrupt_record"
#: Fixed value: the numbers of ``operators.parse.NUMBER_RE`` in RE2's syntax.
NUMBER = r"^[ \t-\r]*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))[ \t-\r]*$"
SIGNED_NAN = r"(?i)[+-]nan"
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("t", pa.float64())])
TYPES = {"traj_id": pa.string(), "points": pa.list_(_POINT), "aim": pa.struct([("ax", pa.float64()), ("ay", pa.float64())]),
         "label": pa.string(), "reason": pa.string(), CORRUPT: pa.string()}


class _Lists:
    """The parts of split texts: ``at(k)`` is the k-th part of each text, or null."""

    def __init__(self, texts: pa.Array, sep: str):
        parts = pc.split_pattern(texts, sep)
        self.values, ends = parts.values, parts.offsets.to_numpy()
        self.start, self.sizes = ends[:-1], np.diff(ends)

    def at(self, k: int) -> pa.Array:
        index = self.start + (k if k >= 0 else self.sizes + k)
        there = self.sizes > k if k >= 0 else self.sizes >= -k
        return self.values.take(pa.array(index, pa.int64(), mask=~there))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def numbers(texts: pa.Array) -> pa.Array:
    """Doubles where Python's float() would take the text, else null."""
    plain = pc.replace_substring_regex(pc.utf8_trim(texts, " \t\n\x0b\x0c\r"), r"^\+", "")
    good = pc.and_(pc.match_substring_regex(texts, NUMBER), pc.invert(pc.match_substring_regex(texts, SIGNED_NAN)))
    return pc.if_else(good, plain, None).cast(pa.float64())


def _any(flags: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owners[flags], minlength=n) > 0


def parse_block(lines: pa.Array, labelled: bool, wanted) -> dict[str, pa.Array]:
    """The wanted columns of a block of lines."""
    n, wanted = len(lines), set(wanted)
    fields = _Lists(lines, " ")
    out = {"traj_id": fields.at(0), "label": fields.at(-1)}
    if not wanted & {"points", "aim", "reason", CORRUPT}:
        return out
    segments = _Lists(pc.fill_null(fields.at(1), ""), ";")
    full = pc.greater(pc.binary_length(segments.values), 0)
    keep = full.to_numpy(zero_copy_only=False)
    owners = segments.owners()[keep]
    coords = _Lists(segments.values.filter(full), ",")
    xyt = [numbers(coords.at(k)) for k in (0, 1, -1)]
    counts = np.bincount(owners, minlength=n)
    out["points"] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32),
                                             pa.StructArray.from_arrays(xyt, fields=list(_POINT)))
    bad = np.zeros(len(owners), bool)
    for c in xyt:
        bad |= c.is_null().to_numpy(zero_copy_only=False)
    target = _Lists(pc.fill_null(fields.at(-2 if labelled else -1), ""), ",")
    wrong = pc.invert(pc.match_substring_regex(target.values, NUMBER)).to_numpy(zero_copy_only=False)
    unaimed = (target.sizes < 2) | _any(wrong, target.owners(), n)
    out["aim"] = pa.StructArray.from_arrays([numbers(target.at(0)), numbers(target.at(1))], names=["ax", "ay"])
    reason = np.where(counts == 0, "no_points", np.where(_any(bad, owners, n), "bad_point", "bad_target"))
    fine = (counts > 0) & ~_any(bad, owners, n) & ~unaimed
    out["reason"] = pa.array(reason, pa.string(), mask=fine)
    out[CORRUPT] = pc.if_else(pa.array(~fine), lines, pa.scalar(None, pa.string()))
    return out


def _filesystem(path: str):
    """File system and its own path of a local path or a URI (``file:/...`` as Spark writes it included)."""
    local = re.match(r"^file:/+", path)
    if local:
        path = "/" + path[local.end():]
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int | None  # None: the whole, compressed file


def split_lines(split: Split, filesystem, block: int = BLOCK):
    """Blocks of whole lines (bytes) that start in ``[start, end)``."""
    if split.end is None:
        f, at = filesystem.open_input_stream(split.path), 0
    else:
        f, at = filesystem.open_input_file(split.path), max(split.start - 1, 0)
        f.seek(at)
    with f:
        rest, skipping = b"", split.end is not None and split.start > 0  # from the byte before: a line may start right here
        while True:
            data = f.read(block)
            ended, data = not data, rest + data
            cut = len(data) if ended else data.rfind(b"\n") + 1
            rest, data = data[cut:], data[:cut]
            if skipping and data:
                first = data.find(b"\n") + 1
                first = first or len(data)
                at, data, skipping = at + first, data[first:], False
            if split.end is not None and at + len(data) >= split.end:
                if at >= split.end:
                    return
                # the last line is the one that holds the byte before the end
                last = data.find(b"\n", split.end - at - 1) + 1
                if last:
                    data, ended = data[:last], True
            at += len(data)
            if data:
                yield data
            if ended:
                return


class TrajectoryReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        if not options.get("path"):
            raise ValueError("a path is required")
        self.mode = options.get("mode", "quarantine")
        if self.mode not in ("quarantine", "strict"):
            raise ValueError(f"unknown mode {self.mode!r}")
        unknown = [c for c in columns if c not in TYPES]
        if unknown:
            raise ValueError(f"no such columns: {', '.join(unknown)}")
        self.path, self.columns = options["path"], columns
        self.labelled = str(options.get("labelled", "true")).lower() == "true"
        if not self.labelled and "label" in columns:
            raise ValueError("unlabelled text has no label")
        self.split_bytes = int(options.get("splitBytes", options.get("splitbytes", SPLIT_BYTES)))
        self.asked: list[bool] = []  # whether reason must be null

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (IsNull, IsNotNull)) and f.attribute == ("reason",):
                self.asked.append(isinstance(f, IsNull))
            else:
                yield f

    def partitions(self):
        filesystem, path = _filesystem(self.path)
        info = filesystem.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(path))
        splits = []
        for f in sorted(found, key=lambda f: f.path):
            if f.type != fs.FileType.File or f.base_name[0] in "_." or not f.size:
                continue
            if f.path.endswith(COMPRESSED):
                splits.append(Split(f.path, 0, None))
            else:
                splits += [Split(f.path, at, min(at + self.split_bytes, f.size)) for at in range(0, f.size, self.split_bytes)]
        return splits or [Split("", 0, 0)]

    def read(self, split):
        if not split.path:
            return
        filesystem, _ = _filesystem(self.path)
        schema = pa.schema([(c, TYPES[c]) for c in self.columns])
        needed = {*self.columns, *(["reason"] if self.asked or self.mode == "strict" else [])}
        for data in split_lines(split, filesystem):
            texts = data.decode("utf-8", "replace").split("\n")
            lines = pa.array([t[:-1] if t.endswith("\r") else t for t in (texts if texts[-1] else texts[:-1])], pa.string())
            got = parse_block(lines, self.labelled, needed)
            if self.mode == "strict" and got["reason"].null_count < len(lines):
                i = got["reason"].is_valid().index(True).as_py()
                raise ValueError(f"bad trajectory record {got['traj_id'][i].as_py()}: {got['reason'][i].as_py()}")
            rows = pa.RecordBatch.from_arrays([got[c] for c in self.columns], schema=schema)
            for null in self.asked:
                flags = got["reason"].is_null() if null else got["reason"].is_valid()
                rows, got = rows.filter(flags), {"reason": got["reason"].filter(flags)}
            if rows.num_rows:
                yield rows


class TrajectoryFormat(DataSource):
    @classmethod
    def name(cls):
        return "trajectories"

    def schema(self):
        label = "label string, " if str(self.options.get("labelled", "true")).lower() == "true" else ""
        return ("traj_id string, points array<struct<x: double, y: double, t: double>>, "
                f"aim struct<ax: double, ay: double>, {label}reason string")

    def reader(self, schema):
        return TrajectoryReader(dict(self.options), schema.fieldNames())


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("trajectories")`` known to the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # a reader that takes filters needs it
    spark.dataSource.register(TrajectoryFormat)
