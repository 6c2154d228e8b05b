"""Tables written between steps, to the storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

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


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame's rows, written to the shared folder and read again.

    A lost executor cannot take them away, later steps do not compute them again, and
    joins on them are planned from their real size.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, each changed until no column of the frame is called so."""
    taken = {column.lower() for column in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def row_number_of(frame: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which have no order, as JSON."""

    def plain(field: StructField) -> Column:
        kind = field.dataType.simpleString()
        return F.to_json(F.struct(f"`{field.name}`")) if "map<" in kind or "variant" in kind else F.col(f"`{field.name}`")

    return F.xxhash64(*[plain(field) for field in frame.schema.fields])
