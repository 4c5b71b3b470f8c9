"""Small steps on the file system of a table that must happen once: claiming a name, publishing a folder."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import is_local_path, local_fs_path


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; of several callers at once only one is told True."""
    data = text.encode()
    if is_local_path(spark, path):
        # Hadoop's local file system looks first and creates then; the operating system does both in one step
        name = local_fs_path(path)
        os.makedirs(os.path.dirname(name), exist_ok=True)
        try:
            handle = os.open(name, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(handle, "wb") as f:
            f.write(data)
        return True
    hadoop, fs = _fs(spark, path)
    try:
        out = fs.create(hadoop, False)
    except Exception:                    # exists already, or was created in between
        if fs.exists(hadoop):
            return False
        raise
    out.write(bytearray(data))
    out.close()
    return True


def claim_number(spark: SparkSession, folder: str, owner: str) -> int:
    """Number of ``owner`` in ``folder``, from 1: the same on every call, and never that of another owner.

    One file per number, created if absent, so two owners that start together get different numbers.
    """
    known = last = None
    if exists(spark, folder):
        taken = spark.read.schema("query string, run int").json(folder)
        known, last = taken.agg(F.min(F.when(F.col("query") == owner, F.col("run"))), F.max("run")).first()
    if known is not None:
        return known
    number = 1 if last is None else last + 1
    while not create_if_absent(spark, f"{folder}/run-{number}.json", json.dumps({"query": owner, "run": number}) + "\n"):
        number += 1
    return number


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _fs(spark, path)
    return fs.exists(hadoop)


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Move a written folder to its place in one step; a folder that is there already stays as it is."""
    source, fs = _fs(spark, staged)
    place, _ = _fs(spark, target)
    if fs.exists(place):
        return False
    fs.mkdirs(place.getParent())
    if not fs.rename(source, place):
        raise OSError(f"cannot move {staged} to {target}")
    return True


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, in order; none if it does not exist."""
    hadoop, fs = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    hadoop, fs = _fs(spark, path)
    fs.delete(hadoop, True)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None while nothing is written."""
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:            # a folder without files
        return None
