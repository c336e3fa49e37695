"""Column-expression helpers shared by every job.

All helpers build Catalyst expressions (no Python row functions), so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schema as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(num, den, digits: int | None = 2) -> Column:
    """``round(100 * num / den, digits)``; NULL when ``den`` is 0 or NULL.

    Spark 4 runs ANSI mode where even double division by zero raises, so
    the division is always ``try_divide``.
    """
    v = F.try_divide(col(num).cast("double") * F.lit(100.0), col(den).cast("double"))
    return F.round(v, digits) if digits is not None else v


def ratio(num, den) -> Column:
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def count_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as bigint (0 on no rows matched)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def distinct_count_small(c) -> Column:
    """COUNT(DISTINCT c) for groups whose distinct values are few (teams of
    a fixture).  ``size(collect_set)`` is a hash aggregate with map-side
    combine and keeps the input's partitioning; ``countDistinct`` mixed with
    other aggregates adds an Expand that discards it and costs two extra
    shuffles.  A hot group with many rows still holds only a few distinct
    values, so the set stays small.  Do not use for unbounded sets."""
    return F.size(F.collect_set(col(c))).cast("long")


def all_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def all_not_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def non_null_count(cols: Iterable[str]) -> Column:
    """Per-row number of non-NULL values among ``cols``."""
    return reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in cols])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             descending: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the smallest (or largest) by ``order``.

    Written as ``min``/``max`` of a struct whose leading fields are the
    ordering columns.  That is an ordinary aggregate, so Spark combines it
    map-side before the shuffle: a key holding a third of all rows is
    reduced inside each input task instead of landing whole in one reducer
    (a ``row_number`` window would sort that key in one task).
    NULLs in ordering columns sort first, as in Spark SQL ``ORDER BY``.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_row"))
    return out.select(*keys, *[F.col(f"_row._o{i}").alias(c) for i, c in enumerate(order) if c not in keys],
                      *[F.col(f"_row.{c}").alias(c) for c in rest])


def map_status(state_id) -> Column:
    """Provider state id -> status code; unknown ids give UNKNOWN."""
    pairs = []
    for k, v in S.STATE_ID_TO_STATUS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(state_id).cast("int")),
                      F.lit(S.UNKNOWN_STATUS))


def map_period(description) -> Column:
    """Period description -> curated label; NULL/empty -> NULL, unknown passes through."""
    d = F.lower(col(description))
    return (F.when(col(description).isNull() | (col(description) == ""), F.lit(None).cast("string"))
            .when(d.contains("1st-half") | d.contains("first half"), F.lit("first_half"))
            .when(d.contains("2nd-half") | d.contains("second half"), F.lit("second_half"))
            .when(d.contains("extra-time"), F.lit("extra_time"))
            .when(d.contains("penalties"), F.lit("penalties"))
            .otherwise(col(description)))


def coerce(c, target: str) -> Column:
    """Typed coercion of a string/variant cell; failures become NULL.

    * ``double``: a ``%`` anywhere is stripped first (``'54.64%'`` -> 54.64)
    * ``int``/``long``: numeric text, or a JSON number truncated toward zero
    * ``boolean``: true/1/yes/t and false/0/no/f, case-insensitive
    Input of VariantType is read with ``try_variant_get`` so JSON numbers
    and JSON strings keep their distinct meaning (3.7 -> 3, "3.7" -> NULL).
    """
    c = col(c)
    if target in ("int", "long", "bigint", "integer"):
        return _int_from_text(c, target)
    if target == "double":
        s = F.trim(F.replace(c.cast("string"), F.lit("%"), F.lit("")))
        return s.try_cast("double")
    if target == "boolean":
        s = F.lower(c.cast("string"))
        return (F.when(s.isin(*S.TRUE_WORDS), F.lit(True))
                .when(s.isin(*S.FALSE_WORDS), F.lit(False))
                .otherwise(F.lit(None).cast("boolean")))
    return c.try_cast(target)


def _int_from_text(c: Column, target: str) -> Column:
    s = F.trim(c.cast("string"))
    return s.try_cast(target)


def coerce_variant(v, target: str) -> Column:
    """Coercion for VariantType cells (JSON number vs JSON string)."""
    v = col(v)
    if target in ("int", "long"):
        return F.try_variant_get(v, "$", target)
    if target == "double":
        num = F.try_variant_get(v, "$", "double")
        txt = F.try_variant_get(v, "$", "string")
        return F.coalesce(num, coerce(txt, "double"))
    if target == "boolean":
        kind = F.schema_of_variant(v)
        n = F.try_variant_get(v, "$", "long")
        return (F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
                .when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
                      F.when(n == 1, F.lit(True)).when(n == 0, F.lit(False)))
                .when(kind == "STRING", coerce(F.try_variant_get(v, "$", "string"), "boolean")))
    return F.try_variant_get(v, "$", target)


def normalize_types(df: DataFrame) -> DataFrame:
    """Widen integral columns to bigint and floats/decimals to double.

    Registered queries end with this so that results compare by value,
    independent of which engine produced them.
    """
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            out.append(F.col(f"`{f.name}`").cast("long").alias(f.name))
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (summation order changes the last bits)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
