"""Curated-table writes.

Plain Parquet tables have no MERGE, so loads are expressed as DataFrame
transforms that produce the next version of a table; ``versions`` applies
them to the key buckets that a batch touches, and publishes the result.
Every transform is an aggregation or an anti join on the natural key —
partial aggregation keeps a hot key from landing whole in one task.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ----------------------------------------------------------------- A5
def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """A5: write a dataset (Parquet by default; CSV with a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """A5: read a dataset back; CSV needs (and gets) an explicit schema."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(schema).csv(path)
    r = spark.read.format(fmt)
    return (r.schema(schema) if schema is not None else r).load(path)


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing to the shared checkpoint folder the session
    names (``spark.checkpoint.dir``) and reading it back; survives executor
    loss, unlike a local checkpoint.  Every call writes a folder of its own."""
    spark = df.sparkSession
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        from pitchlake.session import checkpoint_dir
        base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ----------------------------------------------------------------- A6
def upsert(existing: DataFrame, batch: DataFrame, key: Sequence[str], order: str | None = None,
           audit: bool = True) -> DataFrame:
    """Last write wins per primary key.

    Batch rows beat existing rows; within the batch the largest ``order``
    wins.  With ``audit`` the original ``created_at`` is kept and
    ``updated_at`` moves to the load time (the intent of the original
    touch-on-update trigger; a delete+insert would reset both).
    Returns the next version of the table.
    """
    cols = [c for c in existing.columns if c not in ("created_at", "updated_at")]
    now = F.current_timestamp()
    # the order column keeps its type: as text, 9 would beat 10
    kind = batch.schema[order].dataType if order else T.StringType()
    stamps = [(F.col(c) if audit and c in existing.columns else F.lit(None)).cast("timestamp").alias(c)
              for c in ("created_at", "updated_at")]
    ex = existing.select(*cols, F.lit(0).alias("_src"), F.lit(None).cast(kind).alias("_ord"), *stamps)
    bt = batch.select(*cols, F.lit(1).alias("_src"), (F.col(order) if order else F.lit(None).cast(kind)).alias("_ord"),
                      *[F.lit(None).cast("timestamp").alias(c) for c in ("created_at", "updated_at")])
    u = ex.unionByName(bt)
    rest = [c for c in cols if c not in key]
    win = F.max(F.struct(F.col("_src"), F.col("_ord"), *[F.col(c) for c in rest])).alias("_w")
    g = u.groupBy(*key).agg(win, F.min("created_at").alias("_created"), F.max("updated_at").alias("_updated"),
                            F.max("_src").alias("_touched"))
    out = g.select(*key, *[F.col(f"_w.{c}").alias(c) for c in rest],
                   F.coalesce(F.col("_created"), now).alias("created_at"),
                   F.when(F.col("_touched") == 1, now).otherwise(F.col("_updated")).alias("updated_at"))
    out = out.select(*existing.columns) if audit else out.select(*cols)
    return out


# ----------------------------------------------------------------- A7
def insert_ignore(existing: DataFrame | None, batch: DataFrame, key: Sequence[str],
                  order: Sequence[str] = (), null_distinct: bool = False,
                  required: Sequence[str] = ()) -> DataFrame:
    """First write wins per unique key; returns the rows to append.

    * inside the batch the first row by ``order`` wins (aggregation);
    * rows whose key already exists are ignored (left anti join);
    * rows violating NOT NULL ``required`` columns are skipped, as an
      ``INSERT OR IGNORE`` would.
    ``null_distinct=True`` reproduces SQL UNIQUE semantics, where NULL key
    parts never collide (such rows are always inserted); the default treats
    NULLs as equal (null-safe ``<=>``), which is what a natural key means.
    """
    from pitchlake.functions.exprs import first_by
    b = batch
    if required:
        b = b.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in required]))
    if null_distinct:
        has_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key])
        nulls, b = b.filter(has_null), b.filter(~has_null)
    b = first_by(b, list(key), list(order)) if order else b.dropDuplicates(list(key))
    if existing is not None:
        # renamed: both sides may come from the same table
        ex = existing.select(*[F.col(k).alias(f"_held_{k}") for k in key])
        cond = reduce(lambda x, y: x & y,
                      [(F.col(k) == F.col(f"_held_{k}")) if null_distinct else F.col(k).eqNullSafe(F.col(f"_held_{k}"))
                       for k in key])
        b = b.join(ex, cond, "left_anti")
    b = b.select(*batch.columns)
    return b.unionByName(nulls) if null_distinct else b


def load_first_wins(existing: DataFrame | None, batch: DataFrame, key: Sequence[str], **kw) -> DataFrame:
    """A7 convenience: the whole next version of a first-wins table."""
    new = insert_ignore(existing, batch, key, **kw)
    return new if existing is None else existing.select(*batch.columns).unionByName(new)


# ----------------------------------------------------------------- A8
def with_audit(df: DataFrame, key: Sequence[str] | None = None, defaults: dict | None = None,
               ts=None) -> DataFrame:
    """Audit stamps, column defaults and a stable surrogate id.

    ``id = xxhash64(natural key)`` is stable across reloads (not dense).
    ``ts`` fixes the stamp (tests); default ``current_timestamp()``."""
    now = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    for c, v in (defaults or {}).items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    if key:
        df = df.withColumn("id", F.xxhash64(*key))
    return df.withColumn("created_at", now).withColumn("updated_at", now)


# ----------------------------------------------------------------- A9
def load_report(items: DataFrame, stored: DataFrame, rejects: DataFrame | None = None,
                empty_items: DataFrame | None = None) -> DataFrame:
    """Items seen, rows stored, rows rejected, items that yielded no rows
    — a one-row DataFrame of independent aggregates."""
    def n(df):
        return df.select(F.count(F.lit(1))).scalar() if df is not None else F.lit(0).cast("long")
    return items.sparkSession.range(1).select(
        n(items).alias("items"), n(stored).alias("rows_stored"),
        n(rejects).alias("rows_rejected"), n(empty_items).alias("empty_items"))


def observe_counts(df: DataFrame, name: str, flags: dict | None = None):
    """A9 (streaming-friendly): attach row counts to an action as an
    Observation instead of running extra jobs.  Returns (df, observation);
    read ``observation.get`` after the action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    for n, cond in (flags or {}).items():
        metrics.append(F.sum(F.when(cond, 1).otherwise(0)).alias(n))
    return df.observe(obs, *metrics), obs
