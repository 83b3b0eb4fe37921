"""Near-duplicate search by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets are one class; everything below works on
classes. In each of `TREES` independent trees a class goes to the node of one chosen minwise token; nodes that
are still large branch again by two more tokens, up to `DEPTH` levels. Two sets with Jaccard similarity 0.8 share a
node of one tree with probability 0.7 or more, so that all twelve trees miss a pair with probability below 1e-6.

Nodes are compared exhaustively, in a way that stays small for groups of many copies as well: first every
member of a node is compared with one hub. Members that are then in one connected component need no further
comparison; only pairs across components do. Large nodes around one hub, from all trees, are one crowd, whose pairs
across components are compared once, in blocks. One-bit sketches of 256 minwise values leave out pairs far below
the threshold (six standard deviations), and every link is confirmed on the full sets.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType

from tidemart.llm.components import components
from tidemart.llm.sieve import sieve
from tidemart.llm.text import LONG, array, in_small_batches, pick, struct
from tidemart.sources.scratch import materialise

TREES, DEPTH, LEAF = 12, 4, 16
#: Shingles of one block of a crowd, and words whose hashes a task remembers.
BLOCK, REMEMBERED = 2_000_000, 1 << 16
#: Minwise values in a sketch, and how many of them can be chosen as path tokens.
SKETCH, TOKENS = 256, 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(0, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words. Those of the latest words are remembered, which most words are found among."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Shingle sets as sorted 64-bit hashes. Remembers the hashes of words for one batch of texts."""

    def __init__(self, size: int):
        self.size, self.known = size, WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        hashes = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.size, len(words))
        total = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            total += _mixed(hashes[k:len(hashes) - n + 1 + k] * _PLACES[k % 64] + np.uint64(k))
        return np.unique(_mixed(total))


def minwise(values: np.ndarray) -> np.ndarray:
    """The smallest value of a set under each of `SKETCH` orders."""
    best = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 2048):
        part = values[at:at + 2048]
        np.minimum(best, np.multiply.outer(part, _FACTORS).min(axis=0), out=best)
    return best


def _bits(best: np.ndarray) -> np.ndarray:
    """One bit of each minwise value, as four 64-bit integers."""
    return np.packbits((_mixed(best) >> np.uint64(63)).astype(np.uint8)).view(np.int64)


_SIGNED = struct(
    n=LONG, set_key=BinaryType(), tokens=array(IntegerType()), s0=LONG, s1=LONG, s2=LONG, s3=LONG
)


def _signatures(size: int):
    @F.pandas_udf(_SIGNED)
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            shingles, rows = Shingler(size), []
            for text in texts:
                values = shingles(text)
                if len(values):
                    best = minwise(values)
                    tokens = (_mixed(best[:TOKENS] + _MIX) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    key = xxhash.xxh3_128_digest(values.tobytes())
                    rows.append((len(values), key, tokens, *map(int, _bits(best))))
                else:
                    rows.append((0, None, None, None, None, None, None))
            yield pd.DataFrame(rows, columns=list(_SIGNED.names)).astype({f"s{i}": "Int64" for i in range(4)})

    return sign


def _sets(size: int):
    @F.pandas_udf(BinaryType())
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            shingles = Shingler(size)
            yield pd.Series([shingles(t).tobytes() for t in texts], dtype=object)

    return sets


@F.pandas_udf(LONG)
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """The size of the intersection of two sets of sorted hashes."""
    out = []
    for x, y in zip(a, b):
        both = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
        both.sort()
        out.append(int((both[1:] == both[:-1]).sum()))
    return pd.Series(out, dtype="int64")


def _apart(a: str, b: str) -> Column:
    """The number of sketch bits in which two rows, or structs, differ."""
    bits = [F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}"))) for i in range(4)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _far(percent: float) -> int:
    """Sketch bits in which two sets of a similarity can differ: the mean and six standard deviations."""
    p = (1 - percent / 100) / 2
    return int(np.ceil(SKETCH * p + 6 * np.sqrt(SKETCH * p * (1 - p))))


BITS = ["s0", "s1", "s2", "s3"]


def _branch(rows: DataFrame, depth: int) -> DataFrame:
    """Rows with `tokens` to their child nodes: one in each tree at the root, two below."""
    if depth == 0:
        step = TOKENS // TREES
        children = [F.xxhash64(F.lit(t), F.get("tokens", F.lit(t * step))) for t in range(TREES)]
    else:
        at = lambda j: F.pmod(F.xxhash64("path", F.lit(j)), F.lit(TOKENS)).cast("int")
        children = [F.xxhash64("path", at(j), F.get("tokens", at(j))) for j in range(2)]
    return rows.select(F.explode(F.array_distinct(F.array(*children))).alias("path"), "cid", *BITS)


def _nodes(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The members of small nodes (`path`, `hub`, `apart`, `cid`, sketch), and of crowds (`hub`, `cid`, `apart`).

    The hub of a node is its smallest class. In a large node, the members near the hub join the hub's crowd, whichever
    tree they come from. Those close to the hub (an estimate of 0.75 at a threshold of 0.8) have all that they can be linked
    with in the crowd and stay there; all others go on to child nodes, if the node has members that are not near the hub.
    Nodes that are still large at the last level are crowds as a whole.
    """
    close, near = SKETCH * (105 - percent) // 200, _far(percent - 25)
    small = crowds = None
    rows = _branch(classes, 0)
    for depth in range(1, DEPTH + 1):
        sizes = rows.groupBy("path").agg(
            F.count("*").alias("members"), F.min(F.struct("cid", *BITS)).alias("h")
        ).where("members > 1")
        rows = rows.join(sizes, "path").withColumn("apart", _apart("", "h."))
        rows = materialise(rows.withColumn("hub", F.col("h.cid")).drop("h"), "nodes")
        last = depth == DEPTH
        leaves = rows.where(F.col("members") <= LEAF)
        leaves = leaves.select("path", "hub", "apart", "cid", *BITS)
        small = leaves if small is None else small.unionByName(leaves)
        large = rows.where(F.col("members") > LEAF)
        if large.isEmpty():
            break
        crowd = (large if last else large.where(F.col("apart") <= near)).select("hub", "cid", "apart")
        crowds = crowd if crowds is None else crowds.unionByName(crowd)
        if last:
            break
        # Where all members are near the hub, the crowd has all their pairs, and there is nothing to go on for.
        mixed = large.where(F.col("apart") > near).select("path").distinct()
        going = large.where(F.col("apart") > close).join(mixed, "path", "left_semi")
        # one row per class for the join, whatever the number of its paths: at most two to the depth in each tree
        going = going.groupBy("cid").agg(F.collect_list("path").alias("paths"))
        going = going.join(classes, "cid").select(F.explode("paths").alias("path"), "cid", "tokens", *BITS)
        rows = _branch(going, depth)
    if crowds is None:
        crowds = rows.select("hub", "cid", "apart").limit(0)
    return small, crowds.distinct()


def _set_table(ids: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """`id` and `set` of the documents with these ids, and of a few more. No text is shuffled."""
    wanted = sieve(materialise(ids, "set-ids"), "id")
    return materialise(docs.where(wanted(F.col("id"))).select("id", _sets(size)("text").alias("set")), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs `a`, `b` of ids whose full sets reach the threshold."""
    pairs = materialise(pairs.distinct(), "pairs")
    sets = _set_table(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, size)
    sided = lambda side: sets.select(F.col("id").alias(side), F.col("set").alias(f"set_{side}"))
    joined = pairs.join(sided("a"), "a").join(sided("b"), "b")
    count = joined.select(
        "a", "b", _common("set_a", "set_b").alias("common"),
        ((F.length("set_a") + F.length("set_b")) / 8).cast("long").alias("total"),
    )
    return count.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b").distinct()


def crowd_links(probes: list[int], builds: list[int], component: list, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links, by place in `sets`, between probes and builds of different components; enough of them to join all that are
    linked."""
    parent = {c: c for c in component}

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    sizes = np.array([len(sets[b]) for b in builds])
    tokens = np.concatenate([sets[b] for b in builds])
    order = np.argsort(tokens)
    tokens, owner = tokens[order], np.repeat(np.arange(len(builds)), sizes)[order]
    links = []
    for p in probes:
        low, high = np.searchsorted(tokens, sets[p], "left"), np.searchsorted(tokens, sets[p], "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(builds))
        for b in np.flatnonzero(100 * common >= percent * (len(sets[p]) + sizes - common)):
            x, y = find(component[p]), find(component[builds[b]])
            if x != y:
                parent[x] = y
                links.append((p, builds[b]))
    return links


def _compare_crowds(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in group["set"]]
        probes, builds = np.flatnonzero(group["probe"]).tolist(), np.flatnonzero(group["build"]).tolist()
        found = crowd_links(probes, builds, group["component"].tolist(), sets, percent) if probes and builds else []
        ids = group["cid"].tolist()
        return pd.DataFrame([(ids[p], ids[b]) for p, b in found], columns=["a", "b"])

    return run


def _crowd_pairs(crowds: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links across components within crowds, confirmed on the full sets.

    Members of other components than the hub's are probes; they are compared with all members, in blocks of about `BLOCK`
    shingles on either side.
    """
    placed = crowds.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "hub", "cid", F.coalesce("component", "cid").alias("component")
    )
    of_hub = labels.select(F.col("node").alias("hub"), F.col("component").alias("of_hub"))
    placed = placed.join(of_hub, "hub", "left").withColumn(
        "probe", F.col("component") != F.coalesce("of_hub", "hub")
    )
    placed = placed.join(classes.groupBy("cid").agg(F.max("n").alias("n")), "cid")
    sizes = placed.groupBy("hub").agg(
        F.ceil(F.sum("n") / BLOCK).alias("build_blocks"),
        F.ceil(F.sum(F.when(F.col("probe"), F.col("n"))) / BLOCK).alias("probe_blocks"),
    ).where("probe_blocks > 0")
    placed = materialise(placed.join(sizes, "hub").drop("of_hub", "n"), "crowds")
    sets = _set_table(placed.select(F.col("cid").alias("id")).distinct(), docs, size)
    block = lambda n: F.pmod(F.xxhash64("cid"), F.col(n))
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    one = (F.col("build_blocks") == 1) & (F.col("probe_blocks") == 1)
    cell = lambda b, p, build, probe: F.struct(
        b.alias("b"), p.alias("p"), F.lit(build).alias("build"), probe.alias("probe"))
    zero = F.lit(0).cast("long")
    cells = F.when(one, F.array(cell(zero, zero, True, F.col("probe")))).otherwise(
        F.concat(
            F.transform(up_to("probe_blocks"), lambda p: cell(block("build_blocks"), p, True, F.lit(False))),
            F.when(F.col("probe"), F.transform(
                up_to("build_blocks"), lambda b: cell(b, block("probe_blocks"), False, F.lit(True))
            )).otherwise(F.array().cast("array<struct<b:bigint,p:bigint,build:boolean,probe:boolean>>")),
        )
    )
    rows = placed.join(sets.withColumnRenamed("id", "cid"), "cid")
    rows = rows.select("hub", "cid", "component", "set", F.explode(cells).alias("c")).select(
        "hub", "cid", "component", "set", "c.*"
    )
    kind = classes.schema["cid"].dataType.simpleString()
    return rows.groupBy("hub", "b", "p").applyInPandas(_compare_crowds(percent), f"a {kind}, b {kind}")


def groups(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_shingles`, `component_id`, `kept`.

    Documents whose shingle sets have a Jaccard similarity of `percent` or more are linked; `component_id` is the smallest
    id that links reach, `kept` whether it is the document's own. A text of fewer than `size` words is one shingle.
    NULL, empty and blank texts have no shingles and are linked with nothing. A row without id is linked with nothing,
    has no component and is kept. Rows that repeat an id are one document. An empty table gives no rows.
    """
    docs = in_small_batches(pick(docs, id_col, text_col)).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = docs.select("id", _signatures(size)("text").alias("g")).select("id", "g.*")
    signed = materialise(signed, "signatures")
    classes = (
        signed.where("n > 0 AND id IS NOT NULL").groupBy("set_key")
        .agg(F.min(F.struct(F.col("id").alias("cid"), "n", "tokens", *BITS)).alias("c"))
    )
    classes = materialise(classes.select("set_key", "c.*"), "classes")
    small, crowds = _nodes(classes.drop("set_key", "n"), percent)
    small, crowds = materialise(small, "members"), materialise(crowds, "crowd-members")

    limit = _far(percent)
    stars = small.unionByName(crowds, allowMissingColumns=True).where((F.col("apart") <= limit) & (F.col("hub") < F.col("cid")))
    links = materialise(_confirmed(stars.select(F.col("hub").alias("a"), F.col("cid").alias("b")), docs, size, percent), "links")
    labels = components(links)

    placed = small.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "cid")), "placed")
    apart = placed.groupBy("path").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = placed.join(apart.where("low < high").select("path"), "path", "left_semi")
    across = mixed.alias("x").join(
        mixed.alias("y"),
        (F.col("x.path") == F.col("y.path")) & (F.col("x.component") < F.col("y.component"))
        & (F.col("x.cid") != F.col("x.hub")) & (F.col("y.cid") != F.col("y.hub")) & (_apart("x.", "y.") <= limit),
    ).select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))
    more = _confirmed(across, docs, size, percent).unionByName(
        _crowd_pairs(crowds.select("hub", "cid").distinct(), labels, classes, docs, size, percent)
    )
    more = materialise(more, "more-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    of_class = classes.select("set_key", "cid").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    of_class = of_class.select("set_key", F.coalesce("component", "cid").alias("component"))
    lowest = signed.join(of_class, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return lowest.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """`docs` with one document of each near-duplicate group, the one with the smallest id.

    Rows without id stay. Rows that repeat a kept id with the same columns are one document and stay once.
    """
    found = materialise(groups(docs, id_col=id_col, **options), "groups")
    gone = materialise(found.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct(), "gone")
    perhaps = sieve(gone, id_col)(F.col(f"`{id_col}`"))
    doubtful = docs.where(perhaps).join(gone, id_col, "left_anti").select(docs.columns)
    kept = docs.where(~perhaps).unionByName(doubtful)
    again = materialise(
        found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(id_col)).count().where("count > 1").drop("count"),
        "repeated",
    )
    if again.isEmpty():
        return kept
    once = kept.join(again, id_col, "left_semi").dropDuplicates([id_col])
    return kept.join(again, id_col, "left_anti").unionByName(once.select(docs.columns))
