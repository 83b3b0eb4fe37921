"""Profiles that merge: one small row per part of a table, so that whole tables and later loads are profiled without reading rows again.

Exact are rows, NULLs, smallest and largest values, count, mean and spread. Distinct values come from HyperLogLog sketches (relative
standard error 1.04 / sqrt(2 ** LOG_K): 1.6 % at 12), quantiles from KLL sketches (rank error about 1.7 %).
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tidemart.operators.quality import Rule, _result

#: Binary digits of the number of cells of a distinct-value sketch.
LOG_K = 12
ROWS = "rows"


def _sketched(col: Column, kind: DataType) -> Column:
    """Values that equal each other exactly if those of the column do, in a type that sketches take."""
    if isinstance(kind, (StringType, BinaryType)):
        return col
    if isinstance(kind, BooleanType):
        return col.cast("int")
    return F.xxhash64(col)


def _number(col: Column, kind: DataType) -> Column | None:
    """The column as a double for means and quantiles; None if it is no number or time."""
    if isinstance(kind, NumericType):
        return col.cast("double")
    if isinstance(kind, DateType):
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return (F.unix_micros(col.cast("timestamp")) / 1e6).cast("double")
    return None


def sketch(df: DataFrame, by: Sequence[str] = (), cols: Sequence[str] | None = None) -> DataFrame:
    """A row per value of `by` (one row without): `rows`, and per column a struct of what merges.

    One pass over the rows; what is shuffled is a row per task and value of `by`. Keep the result, a few KB per column, as a table.
    """
    wanted = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    aggregates = [F.count(F.lit(1)).alias(ROWS)]
    for c in wanted:
        col, kind = F.col(f"`{c}`"), df.schema[c].dataType
        parts = [
            F.count_if(col.isNull()).alias("nulls"), F.min(col).alias("smallest"), F.max(col).alias("largest"),
            F.hll_sketch_agg(F.when(col.isNotNull(), _sketched(col, kind)), F.lit(LOG_K)).alias("distinct"),
        ]
        number = _number(col, kind)
        if number is not None:
            finite = F.when(~F.isnan(number), number)
            parts += [
                F.count(finite).alias("count"), F.avg(finite).alias("mean"), F.coalesce(F.var_pop(finite) * F.count(finite), F.lit(0.0)).alias("m2"),
                F.kll_sketch_agg_double(finite).alias("quantiles"),
            ]
        aggregates.append(F.struct(*parts).alias(c))
    return df.groupBy(*by).agg(*aggregates)


def _between(s: Column) -> Column:
    """The spread between parts: their means around the common one, which loses no digits as squares of means would."""

    def off(p: Column) -> Column:
        return F.coalesce(p["count"] * (p["mean"] - s["mean"]) * (p["mean"] - s["mean"]), F.lit(0.0))

    return F.aggregate(s["means"], F.lit(0.0), lambda total, p: total + off(p))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches put together, of all rows or per value of `by`. Reads sketches only, and its result merges again."""
    aggregates = [F.sum(ROWS).cast("long").alias(ROWS)]
    spreads = {}
    for field in sketches.schema:
        if field.name in (ROWS, *by) or not hasattr(field.dataType, "fieldNames"):
            continue
        s = F.col(f"`{field.name}`")
        parts = [
            F.sum(s["nulls"]).cast("long").alias("nulls"), F.min(s["smallest"]).alias("smallest"), F.max(s["largest"]).alias("largest"),
            F.hll_union_agg(s["distinct"]).alias("distinct"),
        ]
        if "m2" in field.dataType.fieldNames():
            n, mean = F.sum(s["count"]).cast("long"), F.sum(s["count"] * s["mean"]) / F.nullif(F.sum(s["count"]), F.lit(0))
            parts += [
                n.alias("count"), mean.alias("mean"), F.sum(s["m2"]).alias("m2"),
                F.kll_merge_agg_double(s["quantiles"]).alias("quantiles"),
                F.collect_list(F.struct(s["count"].alias("count"), s["mean"].alias("mean"))).alias("means"),
            ]
            spreads[field.name] = field.dataType
        aggregates.append(F.struct(*parts).alias(field.name))
    merged = sketches.groupBy(*by).agg(*aggregates)
    exact = {}
    for name, kind in spreads.items():
        s, between = F.col(f"`{name}`"), _between(F.col(f"`{name}`"))
        exact[name] = F.struct(*[
            (s["m2"] + between).alias("m2") if f == "m2" else s[f].alias(f) for f in kind.fieldNames()
        ]).alias(name)
    return merged.select(*[exact.get(c, F.col(f"`{c}`")) for c in merged.columns])


def profile_of(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """A profile from one merged row: column, rows, nulls, distinct_values (estimate), smallest, largest as text, mean, deviation, and
    quantiles (estimates)."""
    none = F.lit(None).cast("double")
    rows = []
    for field in sketches.schema:
        if field.name == ROWS or not hasattr(field.dataType, "fieldNames"):
            continue
        s = F.col(f"`{field.name}`")
        spread = "m2" in field.dataType.fieldNames()
        asked = F.array(*[F.lit(float(q)) for q in quantiles])
        rows.append(F.struct(
            F.lit(field.name).alias("column"), F.col(ROWS), s["nulls"].alias("nulls"), F.hll_sketch_estimate(s["distinct"]).alias("distinct_values"),
            s["smallest"].cast("string").alias("smallest"), s["largest"].cast("string").alias("largest"),
            (s["mean"] if spread else none).alias("mean"),
            (F.when(s["count"] > 1, F.sqrt(s["m2"] / (s["count"] - 1))) if spread else none).alias("deviation"),
            (F.when(s["count"] > 0, F.kll_sketch_get_quantile_double(s["quantiles"], asked)) if spread else F.lit(None).cast("array<double>")).alias("quantiles"),
        ))
    return sketches.select(F.inline(F.array(*rows)))


def distribution_from(col: str, past: DataFrame, deviations: float = 3.0) -> Rule:
    """As `quality.distribution`, with sketches in place of the history: no past row is read."""

    def measure(df: DataFrame) -> DataFrame:
        s = F.col(f"`{col}`")
        before = merge_sketches(past.select(ROWS, s)).select(
            s["mean"].alias("mean"), F.when(s["count"] > 1, F.sqrt(s["m2"] / (s["count"] - 1))).alias("sd"),
            F.lit(None).cast("double").alias("now"), F.lit(None).cast("long").alias("checked"),
        )
        now = df.agg(
            F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("sd"), F.avg(s).cast("double").alias("now"),
            F.count(s).alias("checked"),
        )
        both = before.union(now).agg(*[F.max(c).alias(c) for c in ("mean", "sd", "now", "checked")])
        ok = F.abs(F.col("now") - F.col("mean")) <= F.col("sd") * deviations
        detail = F.format_string("mean %s, history %s +- %s", "now", "mean", "sd")
        return both.select(*_result("distribution", col, ok, F.col("checked"), F.when(ok, 0).otherwise(F.col("checked")), detail))

    return Rule("distribution", col, measure=measure)


def volume_from(past: DataFrame, tolerance: float = 0.1) -> Rule:
    """As `quality.volume`, with the sketches of the earlier load."""

    def measure(df: DataFrame) -> DataFrame:
        sides = [past.agg(F.sum(ROWS).alias("before"), F.lit(None).cast("long").alias("now")),
                 df.agg(F.lit(None).cast("long").alias("before"), F.count(F.lit(1)).alias("now"))]
        both = reduce(DataFrame.union, sides).agg(F.coalesce(F.max("before"), F.lit(0)).alias("before"), F.max("now").alias("now"))
        off = F.abs(F.col("now") - F.col("before"))
        detail = F.format_string("%s rows, before %s", "now", "before")
        return both.select(*_result("volume", None, off <= F.col("before") * tolerance, F.col("now"), off, detail))

    return Rule("volume", None, measure=measure)
