"""Staging a table that several results read.

``persist`` keeps partitions on the executors (lost blocks are recomputed
from lineage). ``checkpoint`` writes the table to the cluster's shared
``spark.checkpoint.dir`` and cuts the lineage, so a lost executor costs a
re-read rather than a recomputation of the whole plan. ``table`` cuts it too, by a
Parquet table in the same folder: readers that need a few columns read those
only, which suits a wide table that is read again and again (session numbers
count their keys twice and read the rows once). ``unstage`` gives the space back.
No fixed partition count: AQE sizes the shuffles that follow.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from sessionlens.config import delete_path, ensure_checkpoint_dir, scratch_folder

_FOLDERS: dict[int, tuple[DataFrame, str]] = {}  # staged tables and where they lie


def stage(df: DataFrame, *, how: str = "persist",
          level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    if how == "persist":
        return df.persist(level)
    if how == "checkpoint":
        if ensure_checkpoint_dir(df.sparkSession) is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return df.checkpoint(eager=True)
    if how == "table":
        path = scratch_folder(df.sparkSession, "staged")
        df.write.parquet(path)
        staged = df.sparkSession.read.schema(df.schema).parquet(path)
        _FOLDERS[id(staged)] = staged, path
        return staged
    if how == "none":
        return df
    raise ValueError(f"unknown staging mode: {how}")


def unstage(staged: DataFrame) -> None:
    """Free what ``stage`` keeps for a table, once nothing reads it any more. Checkpoints
    are left to Spark's own cleaner."""
    _, path = _FOLDERS.pop(id(staged), (None, None))
    if path is not None:
        delete_path(staged.sparkSession, path)
    else:
        staged.unpersist()
