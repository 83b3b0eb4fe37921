"""Marts that follow their facts: sums, counts and averages per group, kept up from changes without reading the facts again.

A change takes its old row out of the group that held it and puts the new one in. What is stored per group are the number of rows and,
per measured column, the number and the sum of its values, so loads are added up in any order and a group whose rows are all gone
disappears. The largest or smallest value of a group cannot be taken out again, so there is no such measure. Sums of decimals and whole
numbers are exact; sums of doubles carry their rounding.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, LongType

from tidemart.sources.tables import add_rows, fold, read_reduced

SIGN, ROWS = "_sign", "_rows"
KINDS = ("rows", "count", "sum", "avg")


@dataclass(frozen=True)
class Mart:
    """Where a mart is kept, its group columns, and its measures: output name to (kind, column).

    Kinds are `rows` (all rows, no column), `count` (rows with a value), `sum` and `avg`. `buckets` is how many parts a fold can leave
    alone.
    """

    path: str
    groups: tuple[str, ...]
    measures: Mapping[str, tuple[str, str | None]]
    buckets: int = 8

    def __post_init__(self):
        unknown = [kind for kind, _ in self.measures.values() if kind not in KINDS]
        if unknown:
            raise ValueError(f"a mart cannot keep {', '.join(unknown)} up from changes")

    @property
    def columns(self) -> list[str]:
        """The measured columns, each once."""
        return list(dict.fromkeys(col for _, col in self.measures.values() if col is not None))


def signed(changes: DataFrame, position: str | None = None) -> DataFrame:
    """Row images of changes (`before`, `after`; either may be NULL) as rows with `_sign` 1 for what is put in and -1 for what goes.

    With `position`, a column that numbers changes, a change that is there twice counts once.
    """
    if position is not None:
        changes = changes.dropDuplicates([position])
    images = [
        F.when(F.col(side).isNotNull(), F.struct(F.lit(sign).cast("long").alias(SIGN), F.col(f"{side}.*")))
        for side, sign in (("before", -1), ("after", 1))
    ]
    return changes.select(F.inline(F.array_compact(F.array(*images))))


def _total(kind: DataType) -> DataType:
    """A type that holds sums of a column and is its own sum's type."""
    if isinstance(kind, DecimalType):
        return DecimalType(38, kind.scale)
    return DoubleType() if isinstance(kind, (DoubleType, FloatType)) else LongType()


def _number(col: str) -> str:
    return f"_n_{col}"


def _sum(col: str) -> str:
    return f"_s_{col}"


def group_deltas(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """What signed rows add to each group: `_rows`, and `_n_` and `_s_` of each column. Every task first reduces its own rows."""
    aggregates = [F.sum(SIGN).alias(ROWS)]
    for c in columns:
        total = _total(rows.schema[c].dataType)
        value = F.col(c).cast(total)
        aggregates += [
            F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col(SIGN))), F.lit(0)).alias(_number(c)),
            F.coalesce(F.sum(F.when(F.col(SIGN) > 0, value).otherwise(-value)), F.lit(0)).cast(total).alias(_sum(c)),
        ]
    return rows.groupBy(*by).agg(*aggregates)


def merged(deltas: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deltas of one group added up; what has come to nothing is left out."""
    kept = [f for f in deltas.schema if f.name == ROWS or f.name.startswith(("_n_", "_s_"))]
    added = deltas.groupBy(*by).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in kept])
    nothing = F.lit(True)
    for f in kept:
        nothing = nothing & (F.col(f.name) == 0)
    return added.where(~nothing)


def update_mart(
    changes: DataFrame,
    mart: Mart,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    by: Sequence[str] | None = None,
    source: str | None = None,
    batch: int | None = None,
    position: str | None = None,
) -> int | None:
    """Add one load of changes to the mart; a batch of a named source that is already in adds nothing.

    Changes are first summed per `by`, columns of the row images (by default the groups); `shape` then turns those into rows with the
    group columns, by a join with dimensions for instance, so it works on few rows. A row whose dimension gives it another
    group is a change of the row: send its image with the old and the new attribute.
    """
    deltas = group_deltas(signed(changes, position), by or mart.groups, mart.columns)
    if shape is not None:
        deltas = shape(deltas)
    return add_rows(merged(deltas, mart.groups), mart.path, source, batch, mart.groups, mart.buckets)


def read_mart(spark: SparkSession, mart: Mart, groups: DataFrame | None = None) -> DataFrame | None:
    """The mart as its facts' aggregate would give it: group columns and measures, only groups with rows.

    With `groups`, a DataFrame of group columns, only the buckets that can hold them are opened, and only they come.
    """
    found = read_reduced(spark, mart.path, lambda rows: merged(rows, mart.groups), groups)
    if found is None:
        return None
    if groups is not None:
        asked = groups.select(*[F.col(g).alias(f"_asked_{g}") for g in mart.groups])
        same = [F.col(g).eqNullSafe(F.col(f"_asked_{g}")) for g in mart.groups]
        found = found.join(asked, same, "left_semi")

    def measure(kind: str, col: str | None) -> Column:
        if kind == "rows":
            return F.col(ROWS)
        if kind == "count":
            return F.col(_number(col))
        value = F.col(_sum(col)) if kind == "sum" else F.col(_sum(col)).cast("double") / F.col(_number(col))
        return F.when(F.col(_number(col)) > 0, value)

    return found.where(F.col(ROWS) > 0).select(
        *mart.groups, *[measure(kind, col).alias(name) for name, (kind, col) in mart.measures.items()]
    )


def fold_mart(spark: SparkSession, mart: Mart) -> DataFrame | None:
    """One stored row per group again, in the buckets that loads have touched."""
    return fold(spark, mart.path, lambda rows: merged(rows, mart.groups))
