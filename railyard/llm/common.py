"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.session import scratch_path

# words of the contracts: runs without ASCII white space
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts the lineage in files that every executor can reach, so a lost
    executor only repeats its own reads; ids drawn before the write
    (``monotonically_increasing_id``) are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession, rows: int) -> None:
    """Bound what one Arrow batch carries to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def small_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, none of them empty.

    This bounds what a task holds without touching the session's settings; a
    row above the bound is a batch of its own.
    """
    for batch in batches:
        todo = [batch]
        while todo:
            b = todo.pop()
            if b.num_rows > 1 and b.nbytes > most:
                half = b.num_rows // 2
                todo += [b.slice(half), b.slice(0, half)]
            elif b.num_rows:
                yield b


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone (missing ones as null), so that further
    columns of the input cannot clash with the operator's own."""
    have = set(df.columns)
    return df.select(*[df[n] if n in have else F.lit(None).alias(n) for n in names])


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`").alias(name)


def map_rows(df: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name: batches come and go by position."""
    def numbered(fields):
        return T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fn(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(batch.num_columns)])

    into = numbered(schema.fields)
    return df.toDF(*numbered(df.schema.fields).names).mapInArrow(run, into).toDF(*schema.names)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
