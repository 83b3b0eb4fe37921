"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has an exponential key, `-ln(u) / weight`, with `u` from a hash of its id, so reruns agree. Within a
source, documents are taken by ascending key until the source's budget of words is used up. A budget larger than the
source first takes all of it once, twice and so on; only what is left over is sampled. The document on the boundary
gives the words that still fit.

No source is ever sorted as a whole: word counts per key range find the range in which the budget ends, and only
that range is ordered. What remains per source is one boundary, which any pass over the documents can apply.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.text import WORD, free_name
from tidemart.sources.scratch import materialise

RANGES = 512
SYMBOLS = "#*$%&|<>!{}[]~^"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, falling with the share of symbols and exclamation marks."""
    noise = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    return (size + F.lit(1)).cast("double") / (size + F.lit(1) + F.lit(10) * noise).cast("double")


def sampling_key(doc_id: Column, weight: Column) -> Column:
    digits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10)
    uniform = (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.ln(uniform) / weight


def targets(sizes: DataFrame, weights: Sequence[int], most: int = 3) -> DataFrame:
    """`target` words for each source of `sizes` (`source`, `source_size`, one row per source).

    Sources in code point order, NULL last, have the given weights in turn. Together they get the words of all
    sources; a target ends at `most` times its source, and what is over goes to the others by weight. The order over
    all sources needs one task, which sees one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*(F.lit(w).cast("long") for w in weights)),
        (((F.row_number().over(by_name) - 1) % len(weights)) + 1).cast("int"),
    )
    ranked = sizes.withColumn("w", weight).withColumn("full", F.col("source_size") * most)
    wide = lambda c: c.cast("decimal(38,0)")
    #: Sources fill up in the order of their size by weight.
    order = Window.orderBy((F.col("full").cast("double") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filling = ranked.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        F.coalesce(F.sum("full").over(before), F.lit(0)).alias("given"),
        F.sum("w").over(after).alias("open_w"),
    ).withColumn(
        "capped", wide(F.col("full")) * F.col("open_w") <= F.col("w") * wide(F.col("total") - F.col("given"))
    )
    rest = filling.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("full"))).over(Window.partitionBy()), F.lit(0)).alias("taken"),
        F.sum(F.when(~F.col("capped"), F.col("w"))).over(Window.partitionBy()).alias("shared_w"),
    )
    share = (F.col("w") * wide(F.col("total") - F.col("taken"))).cast("double") / F.col("shared_w")
    return rest.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("full").cast("double")).otherwise(share).alias("target"),
    )


def boundaries(sized: DataFrame, weights: Sequence[int], most: int = 3) -> DataFrame:
    """Per source: its size, target, complete epochs, and where the fractional selection ends.

    `sized` has `source`, `tie`, `size` and `key`. Rows that sort below `cut` (a struct of key, tie and size) are
    taken, rows equal to it give `cut_words` each, the others nothing. Documents of equal key, tie and size are alike,
    so they share what is left evenly.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("epochs", epochs.cast("long"))
    left = F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    goal = goal.withColumn("budget", F.greatest(left, F.lit(0)))
    steps = [i / RANGES for i in range(1, RANGES)]
    edges = sized.groupBy("source").agg(F.percentile_approx("key", steps, 10_000).alias("edges"))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    goal = materialise(
        goal.alias("g").join(edges.alias("e"), same("g", "e")).select("g.*", "e.edges"), "mix-goals"
    )
    at = F.size(F.filter(F.array_distinct("g.edges"), lambda edge: edge < F.col("s.key")))
    placed = sized.alias("s").join(goal.alias("g"), same("s", "g")).select("s.*", "g.budget", at.alias("at"))
    running = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        placed.groupBy("source", "at", "budget").agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .where("before <= budget AND budget < before + words")
        .select("source", "at", "before")
    )
    tied = (
        placed.alias("s").join(crossing.alias("g"), same("s", "g") & (F.col("s.at") == F.col("g.at")))
        .groupBy("s.source", "key", "tie", "size", "budget", "before")
        .agg(F.count("*").alias("n"))
    )
    one_by_one = Window.partitionBy("source").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        tied.withColumn("used", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(one_by_one), F.lit(0)))
        .where("used <= budget AND budget < used + size * n")
        .select(
            "source", F.struct("key", "tie", "size").alias("cut"),
            F.floor((F.col("budget") - F.col("used")) / F.col("n")).cast("long").alias("cut_words"),
        )
    )
    return (
        goal.alias("g").join(cut.alias("c"), same("g", "c"), "left")
        .select("g.source", "g.source_size", "g.target", "g.epochs", "c.cut", "c.cut_words")
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of `docs` with `size` (words), `source_size`, `target` and `taken` words.

    `taken` counts repeats: `epochs` times the size, plus the size if the document is in the fractional selection, plus
    part of it if it is on the boundary. NULL texts have size 0 and take nothing, NULL sources are a source of their
    own, NULL ids count as an empty id. Repeated rows each count. An empty table gives no rows. Own columns replace
    columns of `docs` with the same names.
    """
    text, size, key, source, tie = (free_name(docs, n) for n in ("_text", "_size", "_key", "_source", "_tie"))
    cols = {text: F.col(f"`{text_col}`"), source: F.col(f"`{source_col}`"),
            tie: F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))}
    sized = docs.withColumns(cols).withColumn(size, word_count(F.col(text)))
    sized = sized.withColumn(key, sampling_key(F.col(tie), quality_weight(F.col(text), F.col(size)))).drop(text)
    small = materialise(
        sized.select(*(F.col(a).alias(b) for a, b in ((source, "source"), (tie, "tie"), (size, "size"), (key, "key")))),
        "mix-sizes",
    )
    ends = materialise(boundaries(small, weights, most), "mix-ends")
    ends = ends.select(*(F.col(c).alias(f"_end_{c}") for c in ends.columns))
    joined = sized.join(ends, F.col(source).eqNullSafe(F.col("_end_source")), "left")
    own = F.struct(F.col(key).alias("key"), F.col(tie).alias("tie"), F.col(size).alias("size"))
    part = (
        F.when(F.col("_end_cut").isNull(), F.lit(0))
        .when(own < F.col("_end_cut"), F.col(size))
        .when(own == F.col("_end_cut"), F.col("_end_cut_words"))
        .otherwise(F.lit(0))
    )
    return joined.withColumns(
        {"size": F.col(size), "source_size": F.col("_end_source_size"), "target": F.col("_end_target"),
         "taken": (F.col("_end_epochs") * F.col(size) + part).cast("long")}
    ).drop(size, key, source, tie, *ends.columns)


def mixture(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: a row for each time a document is taken, with the columns of `docs`, `epoch` (from 0) and `words`, its size.

    Documents that nothing is taken of are left out. The last copy of a document on the boundary is there as a whole if at least half of
    its words are taken, else not at all: no text is cut, and a source misses its target by half a document at most, not
    counting equal ones. NULL texts have no words and are left out. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("epoch", "words")]
    clash = {c: f"_own_{c}" for c in names if c in ("size", "source_size", "target", "taken")}
    mixed = mix(docs.withColumnsRenamed(clash), text_col=text_col, **options).where("taken > 0")
    times = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))
    copies = mixed.withColumn("_times", times).where("_times > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)).alias("_epoch")
    )
    return copies.select(
        *(F.col(f"`{clash.get(c, c)}`").alias(c) for c in names), F.col("_epoch").alias("epoch"), F.col("size").alias("words")
    )
