"""Data-quality rules, suites and dataset profiles.

A suite is a list of rules. All row rules are counted in one pass over the data; a uniqueness rule
adds one grouped pass. Results are rows: rule, column, success, checked, unexpected, detail.
"""

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

RESULT = ("rule", "column", "success", "checked", "unexpected", "detail")


class MissingColumns(ValueError):
    """Required columns are absent."""


class QualityGateFailed(RuntimeError):
    """A suite failed and later steps were not run."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__("; ".join(f"{f['rule']} on {f['column'] or 'table'}: {f['detail']}" for f in failures))


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"Missing columns: {', '.join(missing)}")
    return df


@dataclass(frozen=True, eq=False)
class Rule:
    """`bad` marks an unexpected row, `counted` the rows looked at, `verdict` turns counts into success.

    A `grouped` rule gets its counts from one grouping by its column, which all such rules on the column share. Any other
    rule that is not about single rows gives `measure` instead: a one-row result for a DataFrame.
    """

    name: str
    column: str | None = None
    bad: Column | None = None
    counted: Column | None = None
    verdict: Callable[[Column, Column], Column] = lambda checked, unexpected: unexpected == 0
    measure: Callable[[DataFrame], DataFrame] | None = None
    grouped: bool = False

    def result(self, checked: Column, unexpected: Column) -> Column:
        return F.struct(*_result(
            self.name, self.column, self.verdict(checked, unexpected), checked, unexpected, _share(checked, unexpected)
        ))


def not_null(col: str) -> Rule:
    return Rule("not_null", col, F.col(col).isNull(), F.lit(True))


def between(col: str, low, high) -> Rule:
    """Both ends allowed; NULLs are not looked at."""
    return Rule("between", col, ~F.col(col).between(low, high), F.col(col).isNotNull())


def in_set(col: str, values: Sequence) -> Rule:
    """Case-sensitive; NULLs are not looked at."""
    return Rule("in_set", col, ~F.col(col).isin(list(values)), F.col(col).isNotNull())


def row_count_between(low: int, high: int) -> Rule:
    return Rule(
        "row_count_between", None, F.lit(False), F.lit(True), lambda checked, _: checked.between(low, high)
    )


def completeness(col: str, min_ratio: float = 0.99) -> Rule:
    return Rule(
        "completeness", col, F.col(col).isNull(), F.lit(True),
        lambda checked, unexpected: F.coalesce((checked - unexpected) / F.nullif(checked, F.lit(0)), F.lit(1.0)) >= min_ratio,
    )


def _result(rule: str, col: str | None, success: Column, checked: Column, unexpected: Column, detail: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        F.lit(col).cast("string").alias("column"),
        F.coalesce(success, F.lit(False)).alias("success"),
        checked.cast("long").alias("checked"),
        unexpected.cast("long").alias("unexpected"),
        detail.cast("string").alias("detail"),
    ]


def _repeats(df: DataFrame, col: str) -> DataFrame:
    """One row: values looked at, and those that occur more than once."""
    groups = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"),
    )


def unique(col: str) -> Rule:
    """No value twice; NULLs are not looked at."""
    return Rule("unique", col, grouped=True)


def uniqueness(col: str, min_ratio: float = 1.0) -> Rule:
    """Share of values that occur once, exact."""

    def enough(checked: Column, unexpected: Column) -> Column:
        return F.coalesce((checked - unexpected) / F.nullif(checked, F.lit(0)), F.lit(1.0)) >= min_ratio

    return Rule("uniqueness", col, verdict=enough, grouped=True)


def foreign_key(fk: str, parent: DataFrame, pk: str) -> Rule:
    """Every non-NULL value has a parent row."""

    def measure(df: DataFrame) -> DataFrame:
        keys = df.select(fk).filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
        known = parent.select(F.col(pk).alias("_pk")).distinct().withColumn("_known", F.lit(True))
        counted = keys.join(known, F.col(fk) == F.col("_pk"), "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("unexpected"),
        )
        checked, unexpected = F.col("checked"), F.col("unexpected")
        return counted.select(*_result("foreign_key", fk, unexpected == 0, checked, unexpected, _share(checked, unexpected)))

    return Rule("foreign_key", fk, measure=measure)


def distribution(col: str, history: DataFrame, deviations: float = 3.0) -> Rule:
    """The mean lies within `deviations` standard deviations of the historical mean."""

    def measure(df: DataFrame) -> DataFrame:
        none = F.lit(None).cast("double")
        past = history.agg(F.avg(col).cast("double").alias("mean"), F.stddev(col).cast("double").alias("sd"))
        now = df.agg(F.avg(col).cast("double").alias("now"), F.count(col).alias("checked"))
        both = past.select("mean", "sd", none.alias("now"), F.lit(None).cast("long").alias("checked")).union(
            now.select(none, none, "now", "checked")
        ).agg(*[F.max(c).alias(c) for c in ("mean", "sd", "now", "checked")])
        off = F.abs(F.col("now") - F.col("mean"))
        ok = off <= F.col("sd") * deviations
        detail = F.format_string("mean %s, history %s +- %s", "now", "mean", "sd")
        return both.select(*_result("distribution", col, ok, F.col("checked"), F.when(ok, 0).otherwise(F.col("checked")), detail))

    return Rule("distribution", col, measure=measure)


def volume(previous: DataFrame, tolerance: float = 0.1) -> Rule:
    """The row count lies within `tolerance` of an earlier load."""

    def measure(df: DataFrame) -> DataFrame:
        one = F.lit(1).cast("long")
        both = df.agg(F.count(one).alias("now")).select("now", F.lit(None).cast("long").alias("before")).union(
            previous.agg(F.count(one).alias("before")).select(F.lit(None).cast("long"), "before")
        ).agg(F.max("now").alias("now"), F.max("before").alias("before"))
        ok = F.abs(F.col("now") - F.col("before")) <= F.col("before") * tolerance
        detail = F.format_string("%s rows, before %s", "now", "before")
        return both.select(*_result("volume", None, ok, F.col("now"), F.abs(F.col("now") - F.col("before")), detail))

    return Rule("volume", None, measure=measure)


def _share(checked: Column, unexpected: Column) -> Column:
    return F.concat(unexpected.cast("string"), F.lit(" of "), checked.cast("string"), F.lit(" unexpected"))


def _row_rules(df: DataFrame, suite: Sequence[Rule]) -> list[Rule]:
    """The rules about single rows whose column is there."""
    return [r for r in suite if r.measure is None and not r.grouped and (r.column is None or r.column in df.columns)]


def _counts(row_rules: Sequence[Rule]) -> list[Column]:
    counts = []
    for i, rule in enumerate(row_rules):
        counts += [
            F.count_if(rule.counted).alias(f"c{i}"),
            F.count_if(F.coalesce(rule.bad, F.lit(False))).alias(f"u{i}"),
        ]
    return counts


def observed(df: DataFrame, suite: Sequence[Rule]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with the row rules of a suite counted while it is written, and a function from what was written to all results.

    The function is called after the write, with its rows: uniqueness and other rules that need more than single rows read those.
    """
    row_rules = _row_rules(df, suite)
    if not row_rules:
        return df, lambda rows: validate(rows, suite)
    seen = Observation()
    rest = [r for r in suite if r not in row_rules]

    def results(rows: DataFrame) -> DataFrame:
        if rows.isEmpty():  # Spark may leave out a write of nothing, and the counts with it
            return validate(rows, suite)
        counts = seen.get
        structs = [
            rule.result(F.lit(counts[f"c{i}"]).cast("long"), F.lit(counts[f"u{i}"]).cast("long")) for i, rule in enumerate(row_rules)
        ]
        counted = rows.sparkSession.range(1).select(F.inline(F.array(*structs)))
        return counted.unionByName(validate(rows, rest)) if rest else counted

    return df.observe(seen, *_counts(row_rules)), results


def validate(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """One result row per rule. A rule on a missing column fails and says so."""
    absent = [r for r in suite if r.column is not None and r.column not in df.columns]
    present = [r for r in suite if r not in absent]
    row_rules = _row_rules(df, suite)
    results = []
    if row_rules:
        structs = [rule.result(F.col(f"c{i}"), F.col(f"u{i}")) for i, rule in enumerate(row_rules)]
        results.append(df.agg(*_counts(row_rules)).select(F.inline(F.array(*structs))))
    for col in dict.fromkeys(r.column for r in present if r.grouped):
        structs = [r.result(F.col("checked"), F.col("unexpected")) for r in present if r.grouped and r.column == col]
        results.append(_repeats(df, col).select(F.inline(F.array(*structs))))
    results += [rule.measure(df) for rule in present if rule.measure is not None]
    if absent:
        structs = [
            F.struct(*_result(r.name, r.column, F.lit(False), F.lit(0), F.lit(0), F.lit("no such column"))) for r in absent
        ]
        one = df.sparkSession.range(1)
        results.append(one.select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, results)


def unexpected_values(df: DataFrame, rule: Rule) -> DataFrame:
    """Every unexpected value of a row or uniqueness rule with its number of rows."""
    if rule.column not in df.columns:
        return df.sparkSession.createDataFrame([], "value string, rows long")
    counted = F.count(F.lit(1)).alias("rows")
    if rule.grouped:
        groups = df.filter(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("value")).agg(counted)
        return groups.filter(F.col("rows") > 1)
    if rule.bad is None:
        raise ValueError(f"{rule.name} has no unexpected values")
    return df.filter(rule.bad).groupBy(F.col(rule.column).alias("value")).agg(counted)


def failures(results: DataFrame) -> list:
    """Failed results on the driver: at most one per rule."""
    return results.filter(~F.col("success")).collect()


def passed(results: DataFrame) -> bool:
    return results.filter(~F.col("success")).isEmpty()


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, smallest and largest per column, the last two as text.

    Distinct counts are estimates from one pass unless `exact`, which adds a grouped pass per
    column, each reading that column alone.
    """
    numbered = list(enumerate(df.columns))
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in numbered:
        aggregates += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}")]
        if not exact:
            aggregates.append(F.approx_count_distinct(c).alias(f"d{i}"))
    structs = [
        F.struct(
            F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls"),
            (F.lit(None).cast("long") if exact else F.col(f"d{i}")).alias("distinct_values"),
            F.col(f"a{i}").cast("string").alias("smallest"), F.col(f"z{i}").cast("string").alias("largest"),
        )
        for i, c in numbered
    ]
    summary = df.agg(*aggregates).select(F.inline(F.array(*structs)))
    if not exact:
        return summary
    distinct = reduce(DataFrame.union, [
        df.select(c).distinct().agg(F.count(c).alias("exact_values")).select(F.lit(c).alias("column"), "exact_values")
        for c in df.columns
    ])
    return summary.join(distinct, "column").select(
        "column", "rows", "nulls", F.col("exact_values").alias("distinct_values"), "smallest", "largest"
    )
