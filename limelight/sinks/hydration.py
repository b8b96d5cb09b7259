"""K9: partitions of a source lake replace those of a target, staged and then swapped.

1. The source is listed and its schemas reconciled once; a source without rows raises.
2. Its rows are written to a staging folder beside the target, with every column of any
   source file.
3. Row counts per partition of the staging folder are held against the source's.
4. Partition folders are swapped one by one by renames: the target's goes to a backup
   folder, the staged one takes its place. Where a rename fails, the swaps so far are
   undone, so at any failure the target is as it was. The backup goes last.

Folders of the target that the source does not have stay untouched. One driver-side rename
pair a partition; rows are moved by tasks only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limelight.sources.reconcile import read_reconciled


class HydrationError(RuntimeError):
    pass


class Folders:
    """Folder operations on the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory())

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise HydrationError(f"could not move {source} to {target}")

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


def _counts(df: DataFrame, partition_col: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(F.col(partition_col).cast("string")).agg(F.count("*")).collect()}


def stage(src: DataFrame, staging: str, partition_col: str) -> None:
    """Write the source's rows below ``staging`` and hold its row counts per partition against the source's."""
    src.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(staging)
    want, got = _counts(src, partition_col), _counts(src.sparkSession.read.parquet(staging), partition_col)
    if want != got:
        wrong = sorted(k for k in {*want, *got} if want.get(k) != got.get(k))
        raise HydrationError(f"{len(wrong)} staged partitions differ from the source, e.g. {wrong[:5]}")


def swap(folders: Folders, staging: str, target: str, backup: str, partition_col: str) -> int:
    """Put the staged partition folders in place of the target's; all of them or none."""
    names = [n for n in folders.names(staging) if n.startswith(f"{partition_col}=")]
    present = set(folders.names(target))
    folders.make(target)
    folders.make(backup)
    done = []
    try:
        for name in names:
            if name in present:
                folders.move(f"{target}/{name}", f"{backup}/{name}")
                done.append((f"{backup}/{name}", f"{target}/{name}"))
            folders.move(f"{staging}/{name}", f"{target}/{name}")
            done.append((f"{target}/{name}", f"{staging}/{name}"))
    except Exception:
        for moved, home in reversed(done):
            folders.move(moved, home)
        raise
    return len(names)


def replace_partitions_from(spark: SparkSession, source: str, target: str, partition_col: str) -> int:
    """Replace the partitions of ``target`` that ``source`` has; returns their number.

    Other files (``_SUCCESS``) and sibling folders that merely share the source's prefix are
    not read. Raises FileNotFoundError where the source has no rows."""
    if not Folders(spark, source).names(source):
        raise FileNotFoundError(f"no parquet partitions under {source}")
    src = read_reconciled(spark, source)
    if partition_col not in src.columns or src.isEmpty():
        raise FileNotFoundError(f"no parquet partitions under {source}")
    target = target.rstrip("/")
    folders, run = Folders(spark, target), uuid.uuid4().hex
    staging, backup = f"{target}.staging-{run}", f"{target}.backup-{run}"
    try:
        stage(src, staging, partition_col)
        n = swap(folders, staging, target, backup, partition_col)
        folders.remove(backup)
    finally:
        folders.remove(staging)
        if not folders.names(backup):  # what could not be put back stays there
            folders.remove(backup)
    spark.catalog.refreshByPath(target)
    return n
