"""Versioned snapshots of the published rollup (replace-all publish + previous-snapshot read).

A publisher writes its rows into a folder of its own, ``snapshot_version=<n>-<id>``, and then
creates the version's pointer file ``_published/<n>``, which names the folder.  The pointer is
created only if it is absent: of two publishers of one version the first wins, the other's folder
is deleted.  A version without a pointer is not visible, whatever its folder holds, so readers
see whole versions only, and nothing depends on the marker file of a job commit (which a cluster
may switch off).  The current snapshot is the highest version; finding it opens no data file.

The file system must create files exclusively (HDFS and local folders do; an object store
needs conditional writes).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VERSION = "snapshot_version"
POINTERS = "_published"


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _listed(spark: SparkSession, root: str) -> list[int] | None:
    """The published versions of a root; None if it does not exist."""
    fs, path = _path(spark, root, POINTERS)
    if not fs.exists(path):
        return [] if fs.exists(path.getParent()) else None
    names = [status.getPath().getName() for status in fs.listStatus(path) if status.getLen()]  # empty: being written
    return sorted(int(n) for n in names if n.lstrip("-").isdigit())


def _point(spark: SparkSession, root: str, version: int, folder: str) -> bool:
    """Create the version's pointer; False if there is one."""
    fs, path = _path(spark, root, POINTERS, str(version))
    try:
        out = fs.create(path, False)
    except Exception as e:  # noqa: BLE001  (a Java exception, whose class depends on the file system)
        if fs.exists(path):
            return False
        raise e
    out.writeUTF(folder)
    out.close()
    return True


def publish_snapshot(df: DataFrame, root: str, version: int | None = None, check: Callable[[], None] | None = None) -> int:
    """Write ``df`` as a new immutable version under ``root``; returns the version number.

    A version that is published, also meanwhile by another writer, is never replaced (ValueError).
    ``check`` is called once the rows are written and before they become visible; if it raises,
    the rows are deleted and nothing is published.
    """
    spark = df.sparkSession
    version = int(version if version is not None else time.time() * 1000)
    taken = f"snapshot version {version} exists already under {root}"
    if version in (_listed(spark, root) or ()):
        raise ValueError(taken)
    folder = f"{VERSION}={version}-{uuid.uuid4().hex[:12]}"
    fs, path = _path(spark, root, folder)
    try:
        df.write.mode("errorifexists").parquet(path.toString())
        if check is not None:
            check()
        if not _point(spark, root, version, folder):
            raise ValueError(taken)
    except BaseException:
        fs.delete(path, True)
        raise
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The given (default: latest) version, or ``None`` when nothing was published yet.

    A root that holds something else, but no version, is an error and not a first run.
    """
    have = _listed(spark, root)
    if have is None:
        return None
    if version is not None and version not in have:
        raise ValueError(f"no published snapshot version {version} under {root}")
    if not have:
        fs, path = _path(spark, root)
        other = [s.getPath().getName() for s in fs.listStatus(path)]
        other = sorted(n for n in other if not n.startswith(("_", ".", f"{VERSION}=")))
        if other:
            raise ValueError(f"{root} holds no snapshot but {other[:5]}")
        return None
    fs, path = _path(spark, root, POINTERS, str(max(have) if version is None else version))
    pointer = fs.open(path)
    try:
        folder = pointer.readUTF()
    finally:
        pointer.close()
    return spark.read.parquet(_path(spark, root, folder)[1].toString())


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Published versions, one row each."""
    return spark.createDataFrame([(v,) for v in _listed(spark, root) or []], f"{VERSION} bigint")
