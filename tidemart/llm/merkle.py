"""A Merkle tree over a dataset by sibling-shift self-joins.

Nodes are rows with an address: the tree they belong to and their index on the level. A node computes the indices of all slots of
its run, an equijoin fetches the digests there, and the row in slot zero emits the parent. So a level is a join and a grouping on
addresses, which spread evenly however many leaves one tree holds, and levels shrink by the arity. What a level has found is
written, so a lost executor costs one level at most.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.text import UPPER, free_name, pick
from tidemart.operators.ordered import global_positions, null_safe_join, stamped
from tidemart.sources.scratch import materialise

ARITY = 8
#: The columns of a document that a leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(col: Column) -> Column:
    """A value as text that tells its end: `-` for NULL, else its UTF-8 byte count, `:` and the value."""
    text = col.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*cols: Column) -> Column:
    """Lowercase hex sha256 of the encoded values."""
    return F.sha2(F.concat(*(encoded(c) for c in cols)), 256)


def numbered(df: DataFrame, tree: str, order: list[Column], name: str, total: str) -> DataFrame:
    """Rows with their index from 0 within `tree` in `name` and the tree's row count in `total`.

    A range sort over all trees together and one count per tree: a tree that holds most rows is cut like any other. Rows are
    stamped, so that any number of equal rows is cut as well.
    """
    row = free_name(df, "_row")
    placed = global_positions(stamped(df), [F.col(tree).asc_nulls_first(), *order, F.col("_stamp")], row)
    trees = placed.groupBy(tree).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias(total))
    return null_safe_join(placed, trees, [tree]).withColumn(name, F.col(row) - F.col("_first")).drop(row, "_first", "_stamp")


def _over(value: str, arity: int) -> Column:
    return F.expr(f"{value} DIV {arity}")


def text_of(digests: Column) -> Column:
    """Digests that lie in bytes, one after the other, as lowercase hex text."""
    return F.lower(F.hex(digests))


def climb(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """All levels above `nodes` (`tree` long, `at`, `n` nodes on the level, `digest` in bytes), and the top of each tree: `tree`, `top`.

    A level has a row per node below a parent: `tree`, `at`, `left` and `right` (the digests of its siblings on either side, joined)
    and `parent`. A tree of one node has no level. Digests are moved and stored as bytes, half as long as their text.
    """
    levels, tops = [], nodes.where("n = 1").select("tree", F.col("digest").alias("top"))
    height, widest = 0, nodes.agg(F.max("n")).first()[0] or 0
    slot, none = F.pmod("at", F.lit(arity)), F.lit(bytearray())
    while widest > 1:
        open_ = nodes.where("n > 1")
        slots = F.sequence(F.col("at") - slot, F.least(F.col("at") - slot + arity - 1, F.col("n") - 1))
        asks = open_.select("tree", "at", "n", F.explode(slots).alias("other"))
        digests = open_.select("tree", F.col("at").alias("other"), "digest")
        met = asks.join(digests, ["tree", "other"]).groupBy("tree", "at", "n").agg(
            F.array_sort(F.collect_list(F.struct("other", "digest")))["digest"].alias("run")
        )

        def joined(keep) -> Column:
            return F.concat(*(F.when(keep(i), F.coalesce(F.get("run", F.lit(i)), none)).otherwise(none) for i in range(arity)))

        level = materialise(met.select(
            "tree", "at", "n", joined(lambda i: i < slot).alias("left"), joined(lambda i: i > slot).alias("right"),
            F.when(slot == 0, F.unhex(F.sha2(text_of(joined(lambda i: F.lit(True))), 256))).alias("parent"),
        ), f"merkle-{height}")
        levels.append(level)
        nodes = level.where(slot == 0).select(
            "tree", _over("at", arity).alias("at"), _over(f"(n + {arity - 1})", arity).alias("n"),
            F.col("parent").alias("digest"),
        )
        tops = tops.unionByName(nodes.where("n = 1").select("tree", F.col("digest").alias("top")))
        height, widest = height + 1, -(-widest // arity)
    return levels, tops


STEPS = "array<struct<left:binary,right:binary>>"


def with_paths(leaves: DataFrame, levels: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """`leaves` (`tree`, `at` and more) with `steps`: the siblings on the way to the top of the tree, lowest level first.

    From the top down each level joins its parents' paths, so a path is sent once per run of siblings, never once per node.
    """
    none, above = F.array().cast(STEPS), None
    for height in range(len(levels) - 1, -1, -1):
        own = levels[height].select("tree", "at", F.struct("left", "right").alias("own"))
        nodes = leaves.join(own, ["tree", "at"], "left") if height == 0 else own
        step = F.when(F.col("own").isNotNull(), F.array("own")).otherwise(none)
        if above is None:
            above = nodes.withColumn("steps", step).drop("own")
        else:
            parents = above.select("tree", F.col("at").alias("up"), F.col("steps").alias("rest"))
            above = nodes.withColumn("up", _over("at", arity)).join(parents, ["tree", "up"], "left").withColumn(
                "steps", F.concat(step, F.coalesce("rest", none))
            ).drop("own", "up", "rest")
    return leaves.withColumn("steps", none) if above is None else above


def folded(leaf: Column, steps: Column) -> Column:
    """The top, as text, that a leaf's text and the siblings on its way lead to."""
    return F.aggregate(
        steps, leaf, lambda digest, step: F.sha2(F.concat(text_of(step["left"]), digest, text_of(step["right"])), 256)
    )


def manifest(
    docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
    changed: dict[str, Column] | None = None, arity: int = ARITY,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified`.

    Every value of `tree_col` has a tree over its rows in the order of their ids; the tops of all trees, in the order of the
    values (NULL first, then by UTF-8 bytes), are the leaves of the last tree. `proof_sha256` stands for the siblings on the way
    from the leaf to the root. `changed` maps columns to what they hold when the manifest is checked: `folded_root` is what the
    changed row and the original siblings give, and the row is `verified` if that is the root.

    NULL values are leaves like others, NULL ids come first, NULL trees are one tree. Rows of one id follow each other by their
    leaf; equal rows are leaves of their own and share their digests, not their place. Empty texts differ from NULL. A single row
    is its own root with an empty proof. An empty table gives no rows. Other columns are left out.
    """
    changed = changed or {}
    docs = pick(docs, *dict.fromkeys((id_col, tree_col, *columns)))
    now = [changed.get(c, F.col(f"`{c}`")) for c in columns]
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{tree_col}`").cast("string").alias("name"),
        F.unhex(leaf_digest(*(F.col(f"`{c}`") for c in columns))).alias("leaf"), F.unhex(leaf_digest(*now)).alias("found"),
    )
    placed = numbered(leaves, "name", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "at", "n")
    names = placed.select("name").distinct()
    trees = numbered(names.withColumn("all", F.lit(0).cast("long")), "all", [F.col("name").asc_nulls_first()], "tree", "trees")
    trees = materialise(trees.select("name", "tree", "trees"), "trees")
    placed = materialise(null_safe_join(placed, trees, ["name"]).drop("name"), "leaves")

    levels, tops = climb(placed.select("tree", "at", "n", F.col("leaf").alias("digest")), arity)
    tops = materialise(tops.join(trees.select("tree", "trees"), "tree"), "subroots")
    ends = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("trees").alias("n"), F.col("top").alias("digest"))
    last, root = climb(ends, arity)
    whole = root.select("tree", F.col("top").alias("root"))  # one row
    ends = with_paths(ends.select("tree", "at", F.col("digest").alias("subroot")), last, arity).join(whole, "tree").select(
        F.col("at").alias("tree"), "subroot", "root", F.col("steps").alias("onward")
    )
    found = with_paths(placed.drop("n", "trees"), levels, arity).join(materialise(ends, "tops"), "tree")
    way = F.concat("steps", "onward")
    proof = F.array_join(F.transform(way, lambda s: text_of(F.concat(s["left"], s["right"]))), "")
    return found.select(
        "doc_id", *(text_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")), F.sha2(proof, 256).alias("proof_sha256"),
        folded(text_of(F.col("found")), way).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_third(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text after tampering: A-Z lower-cased in rows whose unsigned crc32 of the decimal id is divisible by 3."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(F.col(text_col), UPPER, UPPER.lower())).otherwise(F.col(text_col))
