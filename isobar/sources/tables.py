"""Catalog tables: loads, partitioned and bucketed layouts, statistics, sizes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, NumericType, StringType, StructField, StructType
from pyspark.sql.window import Window

from isobar.functions.columns import stable_round
from isobar.operators.skew import GROUP_ROWS, split_hot

MAX_BUCKETS = 65_536
HISTOGRAMS = "spark.sql.statistics.histogram.enabled"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _writer(df: DataFrame, fmt: str, path: str | None):
    w = df.write.format(fmt)
    if fmt in ("orc", "parquet"):
        w = w.option("compression", "snappy")
    return w.option("path", path) if path else w


def buckets_for(rows: int, groups: int = 1, rows_per_bucket: int = 2_000_000) -> int:
    """Number of buckets, a power of two, so that a bucket is a fair task.

    A fixed number makes tiny files of a small table and huge tasks of a large one.
    `groups` are partitions that are read apart. Joins, groups and windows by the bucket
    key read a bucket of all partitions in one task: for them the whole table is one group.
    Spark takes MAX_BUCKETS at most; a table that needs more is refused, since its
    buckets would be no fair tasks: partition it further or leave it unbucketed.
    """
    wanted = max(1, rows // max(1, groups) // rows_per_bucket)
    buckets = 1 << (wanted - 1).bit_length()
    if buckets > MAX_BUCKETS:
        raise ValueError(f"{rows} rows in {groups} groups need {buckets} buckets; the limit is {MAX_BUCKETS}")
    return buckets


def load_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Replace the whole table with the frame's rows."""
    _writer(df, fmt, path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_warehouse(
    df: DataFrame,
    name: str,
    parts: Sequence[str] = ("year", "region"),
    buckets: int | None = 32,
    key: str = "station_id",
    path: str | None = None,
    fmt: str = "orc",
) -> DataFrame:
    """Columnar table partitioned by `parts`, optionally bucketed and sorted by `key`.

    Rows are first brought together by partition (and bucket), so that a task
    writes few files. REBALANCE lets the runtime split a group that is too
    large for one task, which a plain repartition by the same columns could not.
    """
    cols = df.columns
    if buckets:
        # The bucket a row will land in, so that one task holds few buckets.
        df = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        df = df.hint("rebalance", *parts, "_bucket").select(*cols)
    elif parts:
        df = df.hint("rebalance", *parts)
    w = _writer(df, fmt, path).mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    if buckets:
        w = w.bucketBy(buckets, key).sortBy(key)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def read_partitions(spark: SparkSession, name: str, **wanted) -> DataFrame:
    """Rows of chosen partitions; a read without any partition bound is refused.

    A value stands for equality, a list for membership, a pair for a closed range.
    """
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    unknown = sorted(set(wanted) - set(parts))
    if unknown:
        raise ValueError(f"not partition columns of {name}: {unknown}")
    if parts and not wanted:
        raise ValueError(f"{name} is partitioned by {parts}: bound at least one of them")
    df = spark.table(name)
    for column, value in wanted.items():
        c = F.col(column)
        if isinstance(value, tuple):
            df = df.where(c.between(*value))
        else:
            df = df.where(c.isin(value) if isinstance(value, list) else c == value)
    return df


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace only those partitions of the table that occur in the frame."""
    spark = df.sparkSession
    rows = _gathered(df, name)
    # insertInto takes the mode from the session, not from a write option.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def append_rows(df: DataFrame, name: str) -> None:
    _gathered(df, name).write.mode("append").insertInto(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, str] | None:
    """(number of buckets, key) of a bucketed table."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in said:
        return None
    return int(said["Num Buckets"]), said["Bucket Columns"].strip("[]`")


def _gathered(df: DataFrame, name: str) -> DataFrame:
    """Rows in the table's columns, brought together by partition and bucket.

    Each task would otherwise write a file for every partition and bucket it holds.
    The runtime splits groups that are too large for one task.
    """
    spark = df.sparkSession
    cols = spark.table(name).columns
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    spec = bucket_spec(spark, name)
    if spec:
        df = df.withColumn("_bucket", F.pmod(F.hash(spec[1]), F.lit(spec[0])))
        by.append("_bucket")
    return (df.hint("rebalance", *by) if by else df).select(*cols)


def bucketed_pair(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fact_table: str,
    dim_table: str,
    buckets: int | None = None,
    fact_path: str | None = None,
    dim_path: str | None = None,
    max_key_rows: int = GROUP_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Both sides bucketed alike on `key`: later joins on it need no shuffle.

    A bucket is read by one task, so keys with too many rows are kept apart in
    an unbucketed table `<fact_table>_hot`. Returns (fact, dim, hot or None).
    """
    buckets = buckets or max(8, buckets_for(fact.count()))
    cold, hot = split_hot(fact, [key], max_key_rows)
    f = write_warehouse(cold, fact_table, (), buckets, key, fact_path, "parquet")
    d = write_warehouse(dim, dim_table, (), buckets, key, dim_path, "parquet")
    if hot is not None:
        hot = load_table(
            hot, f"{fact_table}_hot", path=f"{fact_path}_hot" if fact_path else None
        )
    return f, d, hot


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every frame; Parquet answers it from footers."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def analyze(spark: SparkSession, name: str) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_stats(spark: SparkSession, name: str) -> DataFrame:
    """Catalog statistics as rows: one per column, after ANALYZE.

    Only the catalog's summary lines reach the driver, never table rows.
    """
    analyze(spark, name)
    info = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    }
    said = re.fullmatch(r"\d+ bytes, (\d+) rows", info.get("Statistics", ""))
    if not said:
        raise RuntimeError(f"no row count in the statistics of {name}: {info.get('Statistics')}")
    row_count = int(said[1])
    rows = []
    for field in spark.table(name).schema.fields:
        detail = {
            r["info_name"]: r["info_value"]
            for r in spark.sql(f"DESCRIBE EXTENDED {name} `{field.name}`").collect()
        }

        def number(label: str) -> float | None:
            text = detail.get(label)
            return None if text in (None, "NULL") else float(text)

        def whole(label: str) -> int | None:
            value = number(label)
            return None if value is None else int(value)

        numeric = isinstance(field.dataType, NumericType)
        rows.append(
            (
                field.name,
                row_count,
                whole("num_nulls"),
                whole("distinct_count"),
                number("min") if numeric else None,
                number("max") if numeric else None,
            )
        )
    schema = StructType(
        [
            StructField("column_name", StringType()),
            StructField("row_count", LongType()),
            StructField("null_count", LongType()),
            StructField("distinct_estimate", LongType()),
            StructField("min_value", DoubleType()),
            StructField("max_value", DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def partition_stats(spark: SparkSession, name: str) -> DataFrame:
    """(partition, row_count, bytes) of a partitioned table from the catalog, after ANALYZE."""
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    spark.sql(f"ANALYZE TABLE {name} PARTITION({', '.join(f'`{p}`' for p in parts)}) COMPUTE STATISTICS")
    rows = []
    for shown in spark.sql(f"SHOW PARTITIONS {name}").collect():
        spec = [piece.split("=", 1) for piece in shown[0].split("/")]
        if any(value == "__HIVE_DEFAULT_PARTITION__" for _, value in spec):
            wanted = ", ".join(f"`{k}`=NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"`{k}`='{_plain(v)}'" for k, v in spec)
        else:
            wanted = ", ".join(f"`{k}`='{_plain(v)}'" for k, v in spec)
        info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({wanted})").collect()}
        said = re.fullmatch(r"(\d+) bytes(?:, (\d+) rows)?", info.get("Partition Statistics", ""))
        if not said:
            raise RuntimeError(f"no statistics of {shown[0]}: {info.get('Partition Statistics')}")
        rows.append((shown[0], int(said[2] or 0), int(said[1])))
    return spark.createDataFrame(rows, "partition string, row_count long, bytes long")


def _plain(value: str) -> str:
    """A value as SHOW PARTITIONS escapes it, for a literal."""
    return unquote(value).replace("\\", "\\\\").replace("'", "\\'")


def histogram(spark: SparkSession, name: str, column: str) -> DataFrame:
    """Equal-height bins of a numeric column as the catalog has them: (bin, low, high, distinct, height)."""
    before = spark.conf.get(HISTOGRAMS)
    spark.conf.set(HISTOGRAMS, "true")
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS `{column}`")
    finally:
        spark.conf.set(HISTOGRAMS, before)
    shown = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
    height = re.match(r"height: ([^,]+)", shown.get("histogram") or "")
    if not height:
        raise ValueError(f"no histogram of {name}.{column}")
    rows = []
    for label, text in shown.items():
        if label.startswith("bin_"):
            low, high, distinct = re.fullmatch(r"lower_bound: (.+), upper_bound: (.+), distinct_count: (\d+)", text).groups()
            rows.append((int(label[4:]), float(low), float(high), int(distinct), float(height[1])))
    return spark.createDataFrame(rows, "bin int, low double, high double, distinct long, height double")


STORAGE_FORMATS = ("text", "text_gzip", "orc", "parquet")


def storage_contents(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """What storage_report wrote, read back: rows and totals of every format."""
    parts = []
    for name in STORAGE_FORMATS:
        kind = name if name in ("orc", "parquet") else "csv"
        rows = spark.read.schema(schema).format(kind).option("header", True).load(f"{folder}/{name}")
        parts.append(
            rows.agg(
                F.lit(name).alias("format"),
                F.count("*").alias("rows"),
                stable_round(F.sum("temp_mean"), 2).alias("temp_total"),
                F.count("precipitation").alias("with_precipitation"),
                F.sum("k1").alias("keys_total"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def storage_report(df: DataFrame, folder: str) -> DataFrame:
    """Write the frame as text, gzip text, ORC and Parquet; bytes and share of text."""
    spark = df.sparkSession
    # The frame is worked out once, for Parquet, which the other formats are made from.
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder}/parquet")
    df = spark.read.schema(df.schema).parquet(f"{folder}/parquet")
    df.write.mode("overwrite").option("compression", "snappy").orc(f"{folder}/orc")
    text = df.select(*[F.col(c).cast("string") for c in df.columns])
    text.write.mode("overwrite").option("header", True).csv(f"{folder}/text")
    text.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(
        f"{folder}/text_gzip"
    )

    # One metadata row per file, read without parsing the contents.
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(folder)
        .select("path", "length")
        .withColumn("format", F.regexp_extract("path", r"/(text|text_gzip|orc|parquet)/part-", 1))
    )
    sizes = files.groupBy("format").agg(F.sum("length").alias("bytes"))
    # Four rows by now: one group over all of them is the whole report.
    as_text = F.max(F.when(F.col("format") == "text", F.col("bytes"))).over(
        Window.partitionBy(F.lit(1))
    )
    return sizes.withColumn("text_bytes", as_text).select(
        "format",
        "bytes",
        F.round(F.try_divide(F.col("bytes") * 100.0, F.col("text_bytes")), 1).alias(
            "percent_of_text"
        ),
    )
