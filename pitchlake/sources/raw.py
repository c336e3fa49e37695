"""Landed JSON documents (A1–A3).

Payloads land as indented JSON files, one per fetch: list files for
leagues/teams and envelopes ``{fetch_timestamp, <id>, <payload>}`` for
schedules, statistics, odds and pressure.  They are read with a fixed
schema (never inferred).  Fields whose JSON type varies between number and
text (stat values, prices, flags) are read as VARIANT so that a JSON
number and a JSON string keep their distinct coercion rules.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.session import checkpoint_dir

L, I, S, B, V = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.VariantType()


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SEASON_ITEM = _s(("id", L), ("league_id", L), ("sport_id", L), ("name", S), ("is_current", B), ("finished", B),
                 ("pending", B), ("starting_at", S), ("ending_at", S), ("standings_recalculated_at", S))
LEAGUE_ITEM = _s(("id", L), ("sport_id", L), ("country_id", L), ("name", S), ("active", B), ("short_code", S),
                 ("image_path", S), ("type", S), ("sub_type", S), ("last_played_at", S), ("category", I),
                 ("currentseason", SEASON_ITEM))
TEAM_ITEM = _s(("id", L), ("name", S), ("short_code", S), ("country_id", L), ("image_path", S), ("venue_id", L),
               ("founded", I), ("type", S), ("national_team", B))

PARTICIPANT = _s(("id", L), ("meta", _s(("location", S), ("winner", B))))
SCORE = _s(("description", S), ("participant_id", L), ("score", _s(("goals", I))))
FIXTURE = _s(("id", L), ("league_id", L), ("starting_at", S), ("state_id", I), ("result_info", S),
             ("participants", T.ArrayType(PARTICIPANT)), ("scores", T.ArrayType(SCORE)))
ROUND = _s(("id", L), ("season_id", L), ("finished", B), ("fixtures", T.ArrayType(FIXTURE)))
STAGE = _s(("id", L), ("rounds", T.ArrayType(ROUND)))
SCHEDULE_ENVELOPE = _s(("fetch_timestamp", S), ("season_id", L),
                       ("schedule_data", _s(("data", T.ArrayType(STAGE)))))

STATISTIC = _s(("participant_id", L), ("type", _s(("code", S))), ("data", _s(("value", V))))
PERIOD = _s(("id", L), ("description", S), ("statistics", T.ArrayType(STATISTIC)))
STATS_ENVELOPE = _s(("fetch_timestamp", S), ("fixture_id", L),
                    ("fixture_data_with_stats", _s(("data", _s(("id", L), ("periods", T.ArrayType(PERIOD)))))))

ODD = _s(("fixture_id", L), ("market_id", L), ("bookmaker_id", L), ("label", S), ("value", V), ("name", S),
         ("market_description", S), ("probability", V), ("dp3", S), ("fractional", S), ("american", S),
         ("winning", V), ("stopped", V), ("total", V), ("handicap", V), ("participants", S), ("created_at", S),
         ("original_label", S), ("latest_bookmaker_update", S))
ODDS_ENVELOPE = _s(("fetch_timestamp", S), ("fixture_id", L), ("prematch_odds_data", _s(("data", T.ArrayType(ODD)))))

PRESSURE_ITEM = _s(("id", V), ("minute", V), ("participant_id", V), ("pressure", V))
PRESSURE_ENVELOPE = _s(("fetch_timestamp", S), ("fixture_id", L),
                       ("fixture_data_with_pressure", _s(("data", _s(("id", L),
                                                                      ("pressure", T.ArrayType(PRESSURE_ITEM)))))))

KINDS = {"leagues": LEAGUE_ITEM, "teams": TEAM_ITEM, "schedules": SCHEDULE_ENVELOPE, "stats": STATS_ENVELOPE,
         "odds": ODDS_ENVELOPE, "pressure": PRESSURE_ENVELOPE}


def read_raw(spark: SparkSession, path: str | list[str], kind: str, multiline: bool = True) -> DataFrame:
    """A1: read landed files of one ``kind`` with its fixed schema.

    Files are indented JSON, one document (or one list) per file
    (``multiline=True``, a file is not split); batched landings may be JSON
    lines (``multiline=False``, files are split across tasks).  A list
    file yields one row per item.  Malformed documents keep their text in
    ``_corrupt_record`` (route them with ``split_corrupt``);
    ``_source_file`` records where each row came from."""
    schema = T.StructType(KINDS[kind].fields + [T.StructField("_corrupt_record", S, True)])
    df = (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
            .withColumn("_source_file", F.col("_metadata.file_path")))
    if multiline and kind not in ("leagues", "teams"):
        # one envelope per file: the file identifies the document
        df = df.withColumn("_doc_id", F.xxhash64("_source_file"))
    return df


def parse_documents(docs: DataFrame, kind: str, text_col: str = "doc") -> DataFrame:
    """Parse JSON text documents already in a DataFrame (same schema as A1).

    The fields come out of a generator, so a document is built and parsed
    once: through a projection, Spark would push a later filter on a field
    down and parse the text again for every mention of the field in it."""
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(F.inline(F.array(F.from_json(text_col, KINDS[kind]))), F.xxhash64(text_col).alias("_doc_id"), *rest)


def split_corrupt(raw: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rows the reader could not parse).

    The files are parsed once: one write routes both outputs to a folder of
    their own under ``path`` (default: a new one in the session's shared
    folder), from which they are read back.  (Spark refuses a query on a raw
    JSON scan that needs only the corrupt record column.)"""
    spark = raw.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/parsed/{uuid.uuid4().hex}"
    raw.withColumn("_is_corrupt", F.col("_corrupt_record").isNotNull()).write.partitionBy("_is_corrupt").parquet(path)
    both = spark.read.schema(T.StructType([*raw.schema.fields, T.StructField("_is_corrupt", B)])).parquet(path)
    return both.filter(~F.col("_is_corrupt")).drop("_is_corrupt"), both.filter("_is_corrupt").drop("_is_corrupt")


def corrupt_records(raw: DataFrame) -> DataFrame:
    """Rows the reader could not parse (kept aside, not dropped silently)."""
    return split_corrupt(raw)[1]


# FIXED VALUES: names of landed files, <prefix>_<id>[_stats]_<yyyymmdd>_<hhmmss>.json
FILE_NAME = r"(\d+)(?:_stats)?_(\d{8}_\d{6})\.json$"


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, entity_id, fetched) of the landed files below ``path``, from
    their names alone: no file is opened.  Names without id and time have
    NULLs."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"),
                        F.nullif(F.regexp_extract("path", FILE_NAME, 1), F.lit("")).cast("long").alias("entity_id"),
                        F.nullif(F.regexp_extract("path", FILE_NAME, 2), F.lit("")).alias("fetched"))


def newest_files(files: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """A2 before any JSON is parsed: per entity the file with the latest time
    in its name (ties: the greater path), without the files listed in
    ``seen`` (an earlier result) and those older than what ``seen`` holds of
    their entity."""
    newest = files.where("entity_id is not null").groupBy("entity_id").agg(
        F.max(F.struct("fetched", "file")).alias("_f")).select("entity_id", "_f.fetched", "_f.file")
    if seen is None:
        return newest
    held = seen.groupBy("entity_id").agg(F.max(F.struct("fetched", "file")).alias("_held"))
    return (newest.join(held, "entity_id", "left")
            .where(F.col("_held").isNull() | (F.struct("fetched", "file") > F.col("_held"))).drop("_held"))


def read_newest(spark: SparkSession, path: str, kind: str, seen: DataFrame | None = None, batch: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """A2 over files: (documents of the newest files, index of these files).

    Older files are neither opened nor parsed, so what they hold (corrupt
    text too) costs nothing.  Spark lists a folder's files on the driver for
    any scan; the chosen names (one per entity) are part of that list and go
    to the reader in parts of ``batch`` names."""
    chosen = newest_files(landed_files(spark, path), seen)
    names = [r.file for r in chosen.select("file").orderBy("file").toLocalIterator()]
    if not names:
        empty = T.StructType([*KINDS[kind].fields, T.StructField("_corrupt_record", S), T.StructField("_source_file", S, False), T.StructField("_doc_id", L)])
        return spark.createDataFrame([], empty), chosen
    parts = [read_raw(spark, names[i:i + batch], kind) for i in range(0, len(names), batch)]
    return reduce(DataFrame.unionByName, parts), chosen


def latest_snapshot(raw: DataFrame, key: str, ts: str = "fetch_timestamp", ties: Sequence[Column] = ()) -> DataFrame:
    """A2: keep the most recent landed document per entity.

    Repeated fetches pile up; the newest ``ts`` wins, ties go to the largest
    ``ties``, then to the larger document id.  An aggregation, so a heavily re-fetched entity is combined
    map-side.  Only the time and the id are compared: whole documents hold
    VARIANT values, which have no order."""
    order = [F.col(ts), *ties, *([F.col("_doc_id")] if "_doc_id" in raw.columns else [])]
    newest = F.max_by(F.struct(*raw.columns), F.struct(*order)).alias("_newest")
    return raw.groupBy(key).agg(newest).select(*[F.col(f"_newest.{c}").alias(c) for c in raw.columns])


def read_market_dim(spark: SparkSession, path: str) -> DataFrame:
    """A3: market x bookmaker dimension from the padded CSV: trimmed, typed,
    de-duplicated; the market id keeps one canonical description (the
    alphabetically first name seen for it)."""
    raw = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).csv(path))
    # header names come padded, capitalised and with blanks
    cols = {c: "_".join(c.strip().lower().split()) for c in raw.columns}
    df = raw.select(*[F.trim(F.col(f"`{c}`")).alias(n) for c, n in cols.items()])
    df = df.select(F.col("market_description"), F.col("market_id").try_cast("int").alias("market_id"),
                   F.col("bookmaker_name"), F.col("bookmaker_id").try_cast("int").alias("bookmaker_id"))
    df = df.filter(F.col("market_id").isNotNull() & F.col("bookmaker_id").isNotNull()).dropDuplicates()
    canon = df.groupBy("market_id").agg(F.min("market_description").alias("canonical_market"))
    return df.join(canon, "market_id")
