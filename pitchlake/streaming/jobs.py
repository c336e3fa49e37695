"""Structured Streaming jobs (H1–H4).

Incremental polling-and-append becomes a file stream over the landing
directory.  State is bounded by watermarks; the upsert sink is a
``foreachBatch`` that applies the batch first-wins load (A7) against the
table, so replaying a micro-batch after a failure inserts nothing twice.
Checkpoints live under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.exprs import count_if
from pitchlake.sources.sinks import insert_ignore
from pitchlake.session import checkpoint_dir


def file_stream(spark: SparkSession, directory: str, name: str, max_files: int = 1) -> DataFrame:
    """Stream the Parquet files ``<name>.parquet`` landing in ``directory``
    (schema fixed from the existing data, never inferred per batch)."""
    schema = spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", max_files).parquet(directory))


def _event_time(stream: DataFrame, ts: str) -> tuple[DataFrame, str]:
    """Watermarks need session-zone TIMESTAMP; wall-clock (NTZ) event times
    are converted in the session time zone (UTC) into ``_et``."""
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        return stream.withColumn("_et", F.col(ts).cast("timestamp")), "_et"
    return stream, ts


#: natural key of the timeline
TIMELINE_KEY = ["fixture_id", "minute", "participant_id", "event_type"]


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz")


# ----------------------------------------------------------------- H1
def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, watermark: str = "1 day") -> DataFrame:
    """H1: first-wins de-duplication on a natural key; duplicates arriving
    within the watermark delay are dropped; state older than the watermark
    is evicted (rows later than it are dropped by the engine as late)."""
    cols = stream.columns
    s, et = _event_time(stream, ts)
    return s.withWatermark(et, watermark).dropDuplicatesWithinWatermark(list(keys)).select(*cols)


def normalized_pressure_stream(spark: SparkSession, landing_dir: str, watermark: str | None = None,
                               max_files: int | None = None) -> DataFrame:
    """H1 over landed documents: JSON-lines pressure envelopes streamed
    from ``landing_dir`` and normalised with the batch expressions (B13).

    Repeats are removed by the key-bucketed sink (``first_wins_sink``), which
    looks up the keys of a batch in the table: no state is held, however late
    a document lands, and late ones are not lost.  With a ``watermark``
    repeats fetched within that delay are dropped in front of it, and so are
    documents later than it (``run_counted`` counts both)."""
    from pitchlake.operators.normalize import normalize_pressure
    from pitchlake.sources.raw import parse_documents
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    docs = r.load(landing_dir).withColumnRenamed("value", "doc")
    ok, _ = normalize_pressure(parse_documents(docs, "pressure"))
    if watermark is None:
        return ok
    ok = ok.withColumn("fetch_ts", F.try_to_timestamp("fetch_timestamp"))
    return ok.withWatermark("fetch_ts", watermark).dropDuplicatesWithinWatermark(TIMELINE_KEY).drop("fetch_ts")


# ------------------------------------------------------------- H1 counts
COUNTS = "batch_id bigint, landed bigint, kept bigint, duplicates bigint, late bigint, state_rows bigint"


def run_counted(stream: DataFrame, job, name: str, base: str | None = None, foreach_batch=None, out_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run ``job(stream)`` over everything available now, like
    ``run_available_now``, and keep per micro-batch how many rows landed, were
    kept, dropped as duplicates, and dropped as later than the watermark, and
    how many rows of state are held.  Returns (output, counts of all runs with
    this ``base``)."""
    spark, base = stream.sparkSession, base or stream_dir(stream.sparkSession, name)
    counted = job(stream.observe("landed", F.count(F.lit(1)).alias("n"))).observe("kept", F.count(F.lit(1)).alias("n"))
    progress: list[dict] = []
    out = run_available_now(counted, name, base=base, foreach_batch=foreach_batch, out_path=out_path, progress=progress)
    rows = []
    for p in progress:
        seen = {k: (p.get("observedMetrics") or {}).get(k, {}).get("n", 0) for k in ("landed", "kept")}
        state = p.get("stateOperators") or []
        rows.append((p["batchId"], seen["landed"], seen["kept"], sum(s.get("customMetrics", {}).get("numDroppedDuplicateRows", 0) for s in state),
                     sum(s.get("numRowsDroppedByWatermark", 0) for s in state), sum(s.get("numRowsTotal", 0) for s in state)))
    counts = f"{base}/counts"
    spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("append").parquet(counts)  # a row per micro-batch
    return out, spark.read.schema(COUNTS).parquet(counts)


# ----------------------------------------------------------------- H2
def windowed_mean(stream: DataFrame, ts: str, key: str, value: str, window: str = "15 minutes",
                  watermark: str = "1 hour") -> DataFrame:
    """H2: running mean per key in event-time windows (append mode emits a
    window once the watermark passes its end)."""
    s, et = _event_time(stream, ts)
    g = s.withWatermark(et, watermark).groupBy(F.window(et, window), F.col(key))
    return g.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias(f"avg_{value}")).select(
        _ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"), key, "n",
        f"avg_{value}")


# ----------------------------------------------------------------- H4
def quality_monitor(stream: DataFrame, ts: str, cols: Sequence[str], window: str = "1 day",
                    watermark: str = "1 day", max_null_rate: float = 0.0, rules: dict[str, str] | None = None) -> DataFrame:
    """H4: per window row count, NULL rate of each monitored column and
    breaches of each of ``rules`` (name -> SQL condition of a bad row);
    ``breach`` flags windows whose worst NULL rate exceeds the threshold or
    that break a rule."""
    rules = rules or {}
    s, et = _event_time(stream, ts)
    g = s.withWatermark(et, watermark).groupBy(F.window(et, window))
    aggs = [F.count(F.lit(1)).alias("rows")] + [count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    aggs += [count_if(F.coalesce(F.expr(p), F.lit(False))).alias(f"rule_{n}") for n, p in rules.items()]
    out = g.agg(*aggs).select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                              "rows", *[f"null_{c}" for c in cols], *[f"rule_{n}" for n in rules])
    worst = F.greatest(*[F.col(f"null_{c}") / F.col("rows") for c in cols]) if len(cols) > 1 else \
        F.col(f"null_{cols[0]}") / F.col("rows")
    broken = F.lit(False)
    for n in rules:
        broken = broken | (F.col(f"rule_{n}") > 0)
    return out.withColumn("max_null_rate", worst).withColumn("breach", (F.col("max_null_rate") > max_null_rate) | broken)


# ----------------------------------------------------------------- H3
BUCKET = "_bucket"


def first_wins_sink(table_path: str, key: Sequence[str], order: Sequence[str] = (), buckets: int = 64):
    """H3: ``foreachBatch`` function appending only rows whose key is not
    in the table yet (A7).  Replaying an epoch is a no-op.

    The table is partitioned by a hash bucket of the key, and a batch reads
    only the buckets that its keys fall into, so its cost follows the batch
    (with more buckets than keys in a batch) and not the table."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return
        try:
            existing = spark.read.schema(batch.schema).parquet(table_path).where(F.col(BUCKET).isin(touched))
        except AnalysisException as e:  # only a table that does not exist yet is an empty one
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            existing = None
        new = insert_ignore(existing, batch, key, order=order)
        new.write.mode("append").partitionBy(BUCKET).parquet(table_path)
    return write


# ------------------------------------------------------------- runner
def stream_dir(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint location for one run."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def run_available_now(df: DataFrame, name: str, mode: str = "append", foreach_batch=None,
                      out_path: str | None = None, base: str | None = None, progress: list[dict] | None = None) -> DataFrame:
    """Run a streaming query over everything available now, then return its
    output as a batch DataFrame (Parquet sink, or the foreachBatch table).
    A run with the ``base`` of an earlier one goes on from its checkpoint;
    ``progress`` receives the reports of the run's last micro-batches."""
    spark = df.sparkSession
    base = base or stream_dir(spark, name)
    out_path = out_path or f"{base}/out"
    w = df.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).outputMode("append").start()
    else:
        q = w.outputMode(mode).format("parquet").option("path", out_path).start()
    q.awaitTermination()
    if progress is not None:
        progress += [json.loads(p.json) for p in q.recentProgress]
    return spark.read.parquet(out_path)
