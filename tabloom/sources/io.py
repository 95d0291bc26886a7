"""Sources and sinks (IO1-IO26) as thin, explicit DataFrame reader/writer calls.

Written tables live under the shared folder (``session.scratch_path``), never on a
machine-local temporary path. Partitioned tables are created with an explicit
LOCATION so no metastore is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def write_text(df: DataFrame, col: str, path: str, compression: str | None = None) -> None:
    """IO3 (+IO9): one line per row, several part files; optional bzip2."""
    w = df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """IO1: one row per line; globs allowed."""
    return spark.read.text(path)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """IO2: (path, content) per file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("content"))


def read_files_matching(spark: SparkSession, root: str, fmt: str, glob: str) -> DataFrame:
    """IO21: recursive directory scan keeping file names that match ``glob``."""
    return (spark.read.format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
            .withColumn("_file", F.col("_metadata.file_name")))


def read_files_named(spark: SparkSession, root: str, fmt: str, pattern: str, schema: str | None = None, **opts) -> DataFrame:
    """IO21: recursive directory scan keeping files whose whole name matches the regular expression; the name stays as ``_file``."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true").options(**opts)
    df = (reader.schema(schema) if schema else reader).load(root)
    return df.withColumn("_file", F.col("_metadata.file_name")).filter(F.col("_file").rlike(f"^(?:{pattern})$"))


def write_sequence_file(df: DataFrame, key: str, value: str, path: str) -> None:
    """IO7: (key, value) pairs as a sequence file. The format has no DataFrame writer, so the rows go through an RDD."""
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(path)


def read_sequence_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def write_hadoop_text(df: DataFrame, key: str, value: str, path: str) -> None:
    """IO8: pairs through a Hadoop output format (text: key, tab, value)."""
    pairs = df.select(F.col(key).cast("string"), F.col(value).cast("string")).rdd.map(tuple)
    pairs.saveAsNewAPIHadoopFile(path, "org.apache.hadoop.mapreduce.lib.output.TextOutputFormat", "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text")


def read_hadoop_text(spark: SparkSession, path: str) -> DataFrame:
    """IO8: (offset, line) through a Hadoop input format."""
    rows = spark.sparkContext.newAPIHadoopFile(path, "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    return spark.createDataFrame(rows, "offset long, line string")


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by=None, **opts) -> None:
    """IO15: save modes append / overwrite / ignore / error with hive-style partitions."""
    w = df.write.format(fmt).mode(mode).options(**opts)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def create_partitioned_table(spark: SparkSession, name: str, schema_ddl: str, partition_col: str,
                             fmt: str = "orc", location: str | None = None) -> str:
    """IO17: CREATE TABLE ... USING fmt PARTITIONED BY (col) LOCATION shared path."""
    location = location or scratch_path(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {fmt} PARTITIONED BY ({partition_col}) "
              f"LOCATION '{location}'")
    return location


def overwrite_partition(df: DataFrame, table: str) -> None:
    """IO18: replace exactly the partitions present in ``df`` (dynamic overwrite)."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def create_table_as(df: DataFrame, name: str, mode: str = "error", fmt: str = "parquet") -> DataFrame:
    """IO19 with an explicit mode (trap T22): 'error' refuses an existing table,
    'ignore' keeps it (the create-if-not-exists behaviour), 'overwrite' replaces it."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and mode == "error":
        raise ValueError(f"table {name} exists")
    if exists and mode == "ignore":
        return spark.table(name)
    location = scratch_path(spark, name)
    df.write.format(fmt).mode("overwrite").option("path", location).saveAsTable(name)
    return spark.table(name)


def to_json_rows(df: DataFrame) -> DataFrame:
    """IO26: each row as one JSON string."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("json"))
