"""What the operators of this package share: tables, staged frames, Arrow columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.session import work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Rows for which a task and a file of a staged frame pay.
FILE_ROWS = 100_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a frame to the folder the cluster shares and read it back.

    Cuts lineage in a way that survives lost executors; unlike a checkpoint the
    files are compressed and can be read column by column.

    rows, where known, bounds what the frame's last step reads. It then runs in a task for
    each FILE_ROWS of them, one per core at least, if shuffle partitions are more: on a
    local file system every file starts processes that set its mode, each of which counts
    as a copy of the executor until it has begun.
    """
    path = work_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text counts as empty."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict | pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow where fn may yield {column: values}; Spark's schema gives the Arrow types."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for out in fn(batches):
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                arrays = [
                    v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                    for f, v in ((f, out[f.name]) for f in target)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def arrow_append(
    df: DataFrame, text_col: str, fn: Callable[[list[str]], dict[str, list]], added: str
) -> DataFrame:
    """All columns of a frame and what fn makes of its texts (null: empty); added gives names and types.

    An added name that the frame has already raises.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    more = _parse_datatype_string(added)
    clash = {f.name for f in more} & set(df.columns)
    if clash:
        raise ValueError(f"columns there already: {sorted(clash)}")
    types = to_arrow_schema(more)
    place = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            new = fn([t or "" for t in b.column(place).to_pylist()])
            arrays = [pa.array(new[f.name], type=f.type) for f in types]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], names=[*b.schema.names, *types.names])

    return df.mapInArrow(run, StructType([*df.schema.fields, *more.fields]))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start+length-1 of each span, behind each other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def spread(*cols: str, parts: int) -> Column:
    """A bucket 0 .. parts-1 from a hash of columns; a repeated task gives the same."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(parts)).cast("int")
