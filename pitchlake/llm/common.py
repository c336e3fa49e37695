"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = -(2 ** 63)  # stands for a null id inside joins and maxima


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read lazily through Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The written table survives lost executors, is computed once however
    often it is read, and gives the planner its real size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings (``__`` for ``.``) for the jobs started inside."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as a JVM expression (meant for short strings)."""
    return F.translate(c, UPPER, LOWER)


def id_key(c: str = "doc_id") -> Column:
    """``doc_id`` with null replaced, usable as a join key."""
    return F.coalesce(F.col(c), F.lit(NO_ID))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def utf8_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without building Python strings."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def in_slices(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 16 << 20,
              max_rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds at most ``max_rows`` rows and
    about ``max_bytes`` of ``text`` (a longer text is a slice of its own)."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and (held + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)
