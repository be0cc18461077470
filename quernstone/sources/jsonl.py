"""JSON Lines in and out, with a place for every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str, schema: T.StructType | str, optional: bool = False) -> DataFrame:
    """Rows with _pos (file and place in it). Bad JSON raises. optional: a missing path gives no rows."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if optional and not exists(spark, path):
        return spark.createDataFrame([], kind).withColumn("_pos", F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("at")))
    rows = spark.read.schema(kind).option("mode", "FAILFAST").json(path)
    return rows.withColumn("_pos", F.struct(F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") + 0).alias("at"), F.monotonically_increasing_id().alias("row")))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line; nulls are kept as null, internal columns are not written."""
    rows.drop("_pos").write.mode(mode).option("ignoreNullFields", "false").json(path)
