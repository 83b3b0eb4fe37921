"""Connected components of an edge table by alternating large and small stars.

No neighbour list is ever gathered: a star needs only the smallest neighbour of a node, which is an
aggregate with map-side combine, and a join whose hot keys Spark can split. Each round is written to the shared
scratch folder, so neither the plan nor the loss of an executor reaches back over earlier rounds.
"""

from pyspark.sql import DataFrame, functions as F

from tidemart.sources.scratch import materialise


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (its smallest reachable node) for every node of `edges` (columns `a`, `b`) that is not
    its component's smallest.

    NULL ends and loops are ignored, repeated edges count once. An empty edge table gives no rows. The number of
    rounds is logarithmic in the longest path.
    """
    ordered = (
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen, current = None, materialise(ordered, "edges")
    while True:
        mark = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if mark["n"] == 0 or mark == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = mark
        current = materialise(_small(_large(current).distinct()).distinct(), "edges")
