"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.sources.staging import swap


def spine(spark: SparkSession, count: int, key: str, offset: int = 0) -> DataFrame:
    """``count`` consecutive keys from ``offset``, made on the executors."""
    if count < 1:
        raise ValueError("a spine needs at least one key")
    return spark.range(count).select((F.col("id") + F.lit(offset)).cast("long").alias(key))


# A literal list travels inside the plan, so it must stay a small dimension.
INLINE_LIMIT = 1_000


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small dimension from literal rows and a DDL schema."""
    if not 1 <= len(rows) <= INLINE_LIMIT:
        raise ValueError(f"an inline table holds 1 to {INLINE_LIMIT} rows; write larger ones to a table")
    # Literals of the plan, unfolded in the JVM: a frame made of Python rows would be read
    # through a Python worker in every query that joins it.
    fields = StructType.fromDDL(schema).fields
    structs = [F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# Types of the tables that are read by name. With a schema given, Spark plans a scan
# without a job that reads file footers first.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder, with its declared types if it has any."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def row_counter(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder without any column: enough to count its rows."""
    return spark.read.schema(StructType([])).parquet(f"{folder}/{name}.parquet")


def scan(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """A catalog table by name, in ``schema`` if given."""
    return spark.table(f"{schema}.{table}" if schema else table)


def query_table(spark: SparkSession, text: str, **parameters: str) -> DataFrame:
    """SQL whose tables are named by parameters, as ``IDENTIFIER(:schema || '.name')``."""
    return spark.sql(text, args=parameters)


def write_full(
    frame: DataFrame, table: str, bucket_by: str | None = None, buckets: int = 0,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace a table's rows and schema. Running it again gives the same table.

    The new rows are written beside the table, given to ``check``, which raises if they must
    not be published, and then put in its place: a job that fails leaves the old rows. The
    frame may read the table itself. Tables bucketed alike on a key are joined and grouped
    on it without a shuffle.
    """
    if bool(bucket_by) != (buckets > 0):
        raise ValueError("give both bucket_by and a positive number of buckets, or neither")

    def write(name: str) -> None:
        if bucket_by:
            # One task per bucket writes one sorted file, instead of one file per task and bucket.
            sorted_writer = frame.repartition(buckets, bucket_by).write.format("parquet")
            sorted_writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(name)
        else:
            frame.write.format("parquet").saveAsTable(name)

    swap(frame.sparkSession, table, write, check)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, counted in one job."""
    if not tables:
        raise ValueError("a manifest needs at least one table")
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
