"""Tables written on the way: to shared storage between steps, or beside a table they replace."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data. A session that names none gets one of
    this machine, which is right for a local session only; on a cluster it is an error."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallymark-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def written(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame's rows, written to the shared folder and read again: computed once however
    often they are used, safe from lost executors, and joined by their real size. ``options``
    are those of the writer."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _parts(table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return f"{database}." if database else "", name


def recover(spark: SparkSession, table: str) -> None:
    """Put back the rows that a swap, stopped halfway, had set aside; drop what it left."""
    database, name = _parts(table)
    aside, staged = f"{database}{name}__before", f"{database}{name}__staged"
    if spark.catalog.tableExists(aside):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {staged}")


def swap(spark: SparkSession, table: str, write: Callable[[str], None], check: Callable[[DataFrame], None] | None) -> None:
    """Let ``write`` fill a table beside ``table``, ``check`` its rows, and only then put it in
    the table's place. Whatever fails, the old rows are there, at once or after ``recover``."""
    recover(spark, table)
    database, name = _parts(table)
    staged, aside = f"{database}{name}__staged", f"{database}{name}__before"
    try:
        write(staged)
        if check is not None:
            check(spark.table(staged))
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except BaseException:
        recover(spark, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
