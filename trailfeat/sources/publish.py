"""Outputs that change all at once: data first, then a manifest that names it.

An output path holds ``data/<id>`` folders and ``_manifests/<version>.json``. A job
writes a new data folder with Spark's own writer (phase one); only when that job has
succeeded is a manifest written beside and renamed to the next version (phase two).
Readers take the newest manifest, so a job that fails half-way, at any task, leaves
the former output as it was, and a reader never sees a mixture. Files go through
Hadoop's file system interface, so any path that Spark can write to works; versions
are safe against two writers where a rename to an existing name fails, as on HDFS.

A job with a ``job`` name is published once: run again, it finds its own manifest.
Data folders that no manifest names (failed jobs) and old versions stay until
:func:`sweep` is called.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its paths."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new = jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(conf), new


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of an output, oldest first."""
    fs, new = _hadoop(spark, path)
    found = fs.globStatus(new(f"{path.rstrip('/')}/{MANIFESTS}/[0-9]*.json"))
    names = sorted(str(s.getPath()) for s in found or [])
    if not names:
        return []
    lines = spark.read.text(names, wholetext=True).collect()  # one small row for each kept version
    return sorted((json.loads(r["value"]) for r in lines), key=lambda m: m["version"])


def _announce(spark: SparkSession, path: str, manifest: dict) -> bool:
    """Write a manifest and rename it to its version; False if that version is there already."""
    fs, new = _hadoop(spark, path)
    folder = f"{path.rstrip('/')}/{MANIFESTS}"
    part, final = new(f"{folder}/.{uuid.uuid4().hex}"), new(f"{folder}/{manifest['version']:012d}.json")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(manifest), "utf-8"))
    out.close()
    if not fs.exists(final):
        try:
            if fs.rename(part, final):
                return True
        except Py4JJavaError:
            if not fs.exists(final):
                raise
    fs.delete(part, False)
    return False


def publish(df: DataFrame, path: str, fmt: str = "parquet", job: str | None = None) -> int:
    """Write ``df`` as the next version of the output at ``path``; returns the version."""
    spark = df.sparkSession
    known = manifests(spark, path)
    for m in known:
        if job is not None and m["job"] == job:
            return m["version"]
    folder = f"data/{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(f"{path.rstrip('/')}/{folder}")
    version = known[-1]["version"] + 1 if known else 1
    while not _announce(spark, path, {"version": version, "job": job, "data": folder, "format": fmt,
                                      "schema": df.schema.jsonValue()}):
        newest = manifests(spark, path)[-1]  # another writer came first
        version = max(version, newest["version"]) + 1
    return version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest output at ``path``, or the given version."""
    known = [m for m in manifests(spark, path) if version in (None, m["version"])]
    if not known:
        raise FileNotFoundError(f"nothing published at {path}" + (f" as version {version}" if version else ""))
    m = known[-1]
    reader = spark.read.format(m["format"])
    if m["format"] != "text":
        from pyspark.sql.types import StructType
        reader = reader.schema(StructType.fromJson(m["schema"]))
    return reader.load(f"{path.rstrip('/')}/{m['data']}")


def sweep(spark: SparkSession, path: str, keep: int = 1, min_age_ms: int = 86_400_000) -> int:
    """Remove all but the ``keep`` newest versions, and unnamed data folders older than ``min_age_ms``; returns the folders removed.

    ``min_age_ms`` must exceed the longest job, as a running job's folder has no manifest yet.
    """
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    fs, new = _hadoop(spark, path)
    root = path.rstrip("/")
    known = manifests(spark, path)
    for m in known[:-keep]:
        fs.delete(new(f"{root}/{MANIFESTS}/{m['version']:012d}.json"), False)
    named, removed = {m["data"] for m in known[-keep:]}, 0
    old = {m["data"] for m in known[:-keep]}
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for s in fs.globStatus(new(f"{root}/data/*")) or []:
        folder = f"data/{s.getPath().getName()}"
        if folder not in named and (folder in old or now - s.getModificationTime() > min_age_ms):
            removed += bool(fs.delete(s.getPath(), True))
    return removed
