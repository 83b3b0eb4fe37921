"""Removal of repeated byte strings by merging the Burrows-Wheeler transforms of shards.

A string of `LENGTH` bytes that starts at two places has the same smallest 200-byte hash at the same distance in both,
so only places that share such an anchor can repeat each other. Around each anchor lies a context that holds every string
the anchor can stand for. Contexts that are equal as a whole are repeated as a whole, which settles long copies, in groups
of any size, by counting.

The distinct contexts of shared anchors, cut into symbols of 16 bytes, are what is sorted. A shard of them gets its
Burrows-Wheeler transform by sorting its own suffixes. Transforms are then merged two by two without sorting suffixes again:
the interleave of the two is refined round by round, each round one stable pass over the merged transform that extends the
known common prefix by one symbol. After as many rounds as a string has whole symbols, suffixes that are still in one
block are the repeated intervals; the few bytes that symbols do not align with are compared last.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.llm.packs import PACK, packed, texts, unpacked
from tidemart.llm.text import LONG, pick
from tidemart.sources.scratch import materialise

LENGTH = 400
#: Bytes of an anchor; a string of `LENGTH` has `LENGTH - ANCHOR + 1` candidates.
ANCHOR = 200
REACH = LENGTH - ANCHOR
SYMBOL = 16
#: Bytes of one text looked at together, contexts in a shard, and anchors with so many contexts that no single task sorts them.
PIECE, SHARD, CROWD = 1 << 20, 512, 20_000
#: Contexts merged at once, if no anchor has more: few enough that their symbols have short numbers.
BATCH = 1200
#: Contexts that one group of anchors has on average.
GROUP = 4096

_RNG = np.random.default_rng(20240917)
_VALUES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASES = _RNG.integers(0, 1 << 62, 2, dtype=np.uint64) * np.uint64(4) + np.uint64(3)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_ROOM = PIECE + 4 * LENGTH
_UP = [_powers(b, _ROOM) for b in _BASES]
_DOWN = [_powers(np.uint64(pow(int(b), -1, 1 << 64)), _ROOM) for b in _BASES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """`best` (np.minimum or np.maximum) of each `width` values in a row."""
    n = len(values) - width + 1
    fill = values[-1]
    padded = np.concatenate((values, np.full(-len(values) % width, fill, values.dtype))).reshape(-1, width)
    ahead = best.accumulate(padded, axis=1).ravel()
    back = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the anchors of a text, their hashes, and the hashes of their contexts.

    The context of an anchor at p is what the text has of [p - REACH, p + LENGTH).
    """
    found = []
    for start in range(0, len(data) - LENGTH + 1, PIECE):
        low = max(0, start - LENGTH)
        part = np.frombuffer(data[low:start + PIECE + 2 * LENGTH], np.uint8)
        sums = []
        for values, up in zip(_VALUES, _UP):
            sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[part] * up[:len(part)], dtype=np.uint64))))
        n = len(part) - ANCHOR + 1
        hashes = _mixed((sums[0][ANCHOR:] - sums[0][:n]) * _DOWN[0][:n])
        first, last = start - low, min(start + PIECE, len(data) - LENGTH + 1) - low
        of_windows = _sliding(hashes[first:last + REACH], REACH + 1, np.minimum)
        # a place is the choice of some window that holds it if its hash is the largest choice of those windows
        edge = np.zeros(REACH, np.uint64)
        chosen = hashes[first:last + REACH] == _sliding(np.concatenate((edge, of_windows, edge)), REACH + 1, np.maximum)
        at = np.flatnonzero(chosen) + first
        left, right = np.maximum(at - REACH, 0), np.minimum(at + LENGTH, len(part))
        whole = _mixed((at - left).astype(np.uint64) * np.uint64(1009) + (right - at).astype(np.uint64))
        for total, down in zip(sums, _DOWN):
            whole = _mixed(whole ^ _mixed((total[right] - total[left]) * down[left]))
        found.append((at + low, hashes[at], whole))
    if not found:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    at, hashes, whole = (np.concatenate(x) for x in zip(*found))
    at, once = np.unique(at, return_index=True)
    return at, hashes[once], whole[once]


PLACES = "anchor long, context long, pack long, doc long, at long"


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for number, body in zip(batch["pack"], batch["body"]):
            out = []
            for i, text in enumerate(texts(unpacked(body))):
                at, hashes, whole = anchors(text)
                if len(at):
                    out.append((hashes.view(np.int64), whole.view(np.int64), np.full(len(at), i), at))
            if out:
                anchor, context, doc, at = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"anchor": anchor, "context": context, "pack": number, "doc": doc, "at": at})


CONTEXTS = "anchor long, context long, pack long, doc long, at long, before long, bytes binary"


def _cut_contexts(packs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """The bytes of contexts; `before` is how many of them come before the anchor."""
    data = texts(unpacked(packs["body"].iloc[0])) if len(packs) else []
    low = (wanted["at"] - REACH).clip(lower=0)
    wanted = wanted.assign(
        before=wanted["at"] - low,
        bytes=[data[d][a:b + LENGTH] for d, a, b in zip(wanted["doc"], low, wanted["at"])],
    )
    return wanted[["anchor", "context", "pack", "doc", "at", "before", "bytes"]]


class Transform:
    """The Burrows-Wheeler transform of some strings of symbols.

    `symbols` has the symbol before each suffix, in suffix order; the strings' ends are symbols below all others, one to a
    string. `string` and `at` say where each suffix starts. `block` numbers the runs of suffixes that agree in their first
    `depth` symbols.
    """

    def __init__(self, symbols: np.ndarray, string: np.ndarray, at: np.ndarray, block: np.ndarray):
        self.symbols, self.string, self.at, self.block = symbols, string, at, block


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Numbers of runs of equal keys."""
    new = np.zeros(len(keys[0]), np.int64)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def transform(strings: np.ndarray, first: int) -> Transform:
    """The transform of a shard: the rows of `strings`; their numbers begin at `first`, and their symbols lie above all numbers.

    The end of string s is symbol s. Suffixes are sorted by doubling the prefix that ranks are known for.
    """
    count, width = strings.shape
    text = np.column_stack((strings, np.arange(first, first + count))).ravel()
    offset = np.tile(np.arange(width + 1), count)
    rank, span = text, 1
    while True:
        later = np.zeros(len(text), np.int64)
        inside = np.flatnonzero(offset + span <= width)
        later[inside] = rank[inside + span] + 1
        key = rank * (int(rank.max()) + 2) + later
        order = np.argsort(key)
        rank = np.empty(len(text), np.int64)
        rank[order] = _runs(key[order])
        span *= 2
        if span > width or rank.max() == len(text) - 1:
            break
    order = np.argsort(rank)
    before = np.where(offset > 0, text[np.arange(len(text)) - 1], text[np.arange(len(text)) - offset + width])
    return Transform(before[order], first + order // (width + 1), order % (width + 1), np.arange(len(text)))


def merge(a: Transform, b: Transform, depth: int) -> Transform:
    """The transform of the strings of both, from the two transforms alone, with blocks of common prefixes of `depth` symbols.

    The interleave says for each place in the merged order which of the two transforms comes next. At first it is all of one
    and then all of the other. A round goes through the merged transform in the order known so far and deals the places out by
    symbol: what comes out is in the order of one symbol more. Runs that a round tells apart get a block boundary.
    """
    side = np.concatenate((np.zeros(len(a.symbols), bool), np.ones(len(b.symbols), bool)))
    block = np.zeros(len(side), np.int64)
    highest = max(part.symbols.max(initial=0) for part in (a, b))
    kind = np.uint16 if highest < 1 << 16 else np.int64  # short numbers are sorted by radix
    left, right, merged = a.symbols.astype(kind), b.symbols.astype(kind), np.empty(len(side), kind)
    for _ in range(depth):
        merged[~side], merged[side] = left, right
        order = np.argsort(merged, kind="stable")
        refined = _runs(merged[order], block[order])
        new = side[order]
        if refined[-1] == block[-1] and np.array_equal(new, side):
            break  # all prefixes are told apart as far as they ever will be
        side, block = new, refined
    out = Transform(*(np.empty(len(side), np.int64) for _ in range(3)), block)
    for name in ("symbols", "string", "at"):
        values = getattr(out, name)
        values[~side], values[side] = getattr(a, name), getattr(b, name)
    return out


def merge_all(parts: list[Transform], depth: int) -> Transform:
    """One transform of all parts, merged two by two."""
    if len(parts) == 1:  # its own blocks come from the same refinement, with nothing to interleave
        nothing = Transform(*(np.empty(0, np.int64) for _ in range(4)))
        return merge(parts[0], nothing, depth)
    while len(parts) > 1:
        parts = [merge(*parts[i:i + 2], depth) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _mask(high: int) -> np.uint64:
    """Of the eight bytes of a word, the last `high`."""
    return np.uint64((1 << 64) - (1 << 8 * (8 - high)) if high else 0)


def covered(contexts: list[bytes], before: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context, the bytes before and after its anchor's start that repeated strings reach; 0, 0 if none do.

    `starts` numbers the place of each anchor in the corpus, so that one place seen from two contexts is no repeat.
    """
    lead = -(-REACH // SYMBOL) * SYMBOL  # the anchor starts at a symbol
    width = (lead + LENGTH) // SYMBOL + 1
    frame = np.zeros((len(contexts), width * SYMBOL), np.uint8)
    length = np.array([len(c) for c in contexts])
    low = lead - before
    for i, c in enumerate(contexts):
        frame[i, low[i]:low[i] + len(c)] = np.frombuffer(c, np.uint8)
    high = low + length
    words = frame.view(np.uint64)
    pairs = _mixed(words[:, 0::2]) ^ _mixed(words[:, 1::2] + np.uint64(0x9E3779B97F4A7C15))
    begin = np.arange(width) * SYMBOL
    partial = (begin[None, :] < low[:, None]) | (begin[None, :] + SYMBOL > high[:, None])
    known = np.unique(pairs[~partial], return_inverse=True)[1]
    ends = len(contexts) + int(partial.sum())
    strings = np.empty(pairs.shape, np.int64)
    strings[~partial] = ends + known
    strings[partial] = len(contexts) + np.arange(int(partial.sum()))  # symbols of their own: they equal nothing
    depth = LENGTH // SYMBOL - 1
    whole = merge_all([transform(strings[i:i + SHARD], i) for i in range(0, len(strings), SHARD)], depth)

    # blocks of at least two suffixes that can lie in a string around the anchor
    size = np.bincount(whole.block)
    fit = (size[whole.block] > 1) & (whole.at > 0) & (whole.at * SYMBOL < lead + SYMBOL) & (whole.at <= width - 1 - depth)
    string, at, block = whole.string[fit], whole.at[fit] * SYMBOL, whole.block[fit].astype(np.uint64)
    left, right = np.full(len(contexts), -1), np.full(len(contexts), -1)
    # the sixteen bytes before the symbols that are known to agree, and the sixteen after them
    a0, a1 = words[string, at // 8 - 2], words[string, at // 8 - 1]
    b0, b1 = (words[string, (at + depth * SYMBOL) // 8 + i] for i in (0, 1))
    for d in range(SYMBOL):  # the string starts d bytes before a symbol
        first = at - d
        ok = np.flatnonzero((first >= low[string]) & (first + LENGTH <= high[string]) & (first <= lead) & (first >= lead - REACH))
        if not len(ok):
            continue
        if d <= 8:
            x, y = b0[ok], a1[ok] & _mask(d) | b1[ok] & ~_mask(d)
        else:
            x, y = a1[ok], a0[ok] & _mask(d - 8) | b0[ok] & ~_mask(d - 8)
        key = _mixed(x ^ _mixed(y ^ _mixed(block[ok])))
        order = np.argsort(key)
        run = _runs(block[ok][order], x[order], y[order])
        place = (starts[string[ok]] + (first[ok] - lead))[order]
        edges = np.flatnonzero(np.diff(run, prepend=-1))
        hit = ok[order[(np.minimum.reduceat(place, edges) != np.maximum.reduceat(place, edges))[run]]]
        np.maximum.at(left, string[hit], lead - first[hit])
        np.maximum.at(right, string[hit], first[hit] + LENGTH - lead)
    none = left < 0
    left[none] = right[none] = 0
    return left, right


REACHES = "anchor long, context long, left long, right long"


def _merge_contexts(group: pd.DataFrame) -> pd.DataFrame:
    """Of each context in a group of anchors, the bytes around the anchor that repeats cover."""
    # places of one text keep their distances, others get numbers of their own
    text, base = np.unique(group[["pack", "doc"]].to_numpy(), axis=0, return_inverse=True)
    span = int(group["at"].max()) + 4 * LENGTH
    starts = base.ravel() * span + group["at"].to_numpy()
    group = group.assign(start=starts).sort_values("anchor", ignore_index=True)
    # contexts of one anchor stay together; the shards of a few anchors at a time are merged
    firsts = np.flatnonzero(np.diff(group["anchor"].to_numpy(), prepend=group["anchor"].iloc[0] - 1))
    cuts = [0, *firsts[np.flatnonzero(np.diff(firsts // BATCH)) + 1].tolist(), len(group)]
    out = []
    for low, high in zip(cuts, cuts[1:]):
        part = group.iloc[low:high]
        left, right = covered(part["bytes"].tolist(), part["before"].to_numpy(), part["start"].to_numpy())
        out.append(pd.DataFrame({"anchor": part["anchor"], "context": part["context"], "left": left, "right": right}))
    return pd.concat(out)


STRINGS = "anchor long, context long, pack long, doc long, start long, ahead long, string binary"


def _all_strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of the contexts of crowded anchors, as a hash: the exact way without sorting."""
    for batch in batches:
        out = []
        for anchor, context, pack, doc, at, before, data in batch[[c.split()[0] for c in CONTEXTS.split(", ")]].itertuples(index=False):
            for i in range(min(before, len(data) - LENGTH) + 1):
                string = xxhash.xxh3_128_digest(data[i:i + LENGTH])
                out.append((anchor, context, pack, doc, at - before + i, before - i, string))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STRINGS.split(", ")])


def _crowded(contexts: DataFrame) -> DataFrame:
    """As `covered`. A string counts as repeated if it starts at two places, not if two contexts hold one place."""
    strings = contexts.mapInPandas(_all_strings, STRINGS)
    place = ("pack", "doc", "start")
    twice = strings.groupBy("anchor", "string").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in place for f in (F.min, F.max)))
    twice = twice.where(" OR ".join(f"min_{c} < max_{c}" for c in place)).select("anchor", "string")
    return (
        strings.join(twice, ["anchor", "string"]).groupBy("anchor", "context")
        .agg(F.max("ahead").alias("left"), (LENGTH - F.min("ahead")).alias("right"))
    )


def _keep(kind):
    schema = StructType([
        StructField("doc_id", kind), StructField("n_bytes", LONG), StructField("n_removed", LONG),
        StructField("n_spans", LONG), StructField("kept_sha256", StringType()), StructField("kept", StringType()),
    ])

    def run(packs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        rows = unpacked(packs["body"].iloc[0])
        cuts = {doc: part[["low", "high"]].to_numpy() for doc, part in spans.groupby("doc")}
        out = []
        for i, text in enumerate(texts(rows)):
            keep, runs, end = [], 0, 0
            for low, high in sorted(map(tuple, cuts.get(i, ()))):
                if low > end or (low == 0 and runs == 0):
                    keep.append(text[end:low])
                    runs += 1
                end = max(end, min(high, len(text)))
            keep.append(text[end:])
            rest = b"".join(keep)
            out.append((len(text), len(text) - len(rest), runs, hashlib.sha256(rest).hexdigest(),
                        rest.decode("utf-8", "replace")))
        out = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        out.insert(0, "doc_id", pd.Series(rows["id"].to_pylist(), dtype=object))
        return out

    return run, schema


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack: int = PACK) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, and `kept`, the text left.

    Every byte goes that a string of `LENGTH` bytes covers which also starts anywhere else in the column, the same text
    included. Strings never cross texts, and are judged on the input. NULL and short texts lose nothing. Repeated rows are
    texts of their own, so they repeat each other. `kept` replaces bytes of characters that were cut in two. An empty table gives
    no rows.
    """
    rows = pick(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    packs = packed(rows, pack)
    places = materialise(packs.mapInPandas(_places, PLACES), "places")
    classes = places.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("pack", "doc", "at")).alias("first")
    )
    shared = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    classes = materialise(classes.join(shared, "anchor").select("anchor", "context", "n", "kinds", "first.*"), "contexts")

    whole = classes.where("n > 1").select("anchor", "context", F.lit(REACH).alias("left"), F.lit(LENGTH).alias("right"))
    wanted = classes.where("kinds > 1").select("anchor", "context", "pack", "doc", "at")
    contexts = materialise(
        packs.groupBy("pack").cogroup(wanted.groupBy("pack")).applyInPandas(_cut_contexts, CONTEXTS), "context-bytes"
    )
    crowds = classes.where(F.col("kinds") > CROWD).select("anchor").distinct()
    usual = contexts.join(crowds, "anchor", "left_anti")
    groups = max(1, -(-contexts.count() // GROUP))
    sorted_ = (
        usual.withColumn("of", F.pmod(F.xxhash64("anchor"), F.lit(groups))).groupBy("of")
        .applyInPandas(_merge_contexts, REACHES)
    )
    parts = sorted_.where("right > 0")
    if not crowds.isEmpty():
        parts = parts.unionByName(_crowded(contexts.join(crowds, "anchor", "left_semi")))
    reaches = materialise(
        whole.unionByName(parts).groupBy("anchor", "context").agg(F.max("left").alias("left"), F.max("right").alias("right")),
        "reaches",
    )
    spans = places.join(reaches, ["anchor", "context"]).select(
        "pack", "doc", F.greatest(F.col("at") - F.col("left"), F.lit(0)).alias("low"), (F.col("at") + F.col("right")).alias("high")
    )
    run, schema = _keep(rows.schema["id"].dataType)
    return packs.groupBy("pack").cogroup(spans.groupBy("pack")).applyInPandas(run, schema)
