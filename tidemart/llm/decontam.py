"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over every token window.

The set is broadcast in blocks of at most `BLOCK` n-grams, so what an executor holds is bounded however large the
benchmark grows; a benchmark of several blocks means as many passes over the documents, each written out. A hit is
the equality of all words of the window, not of a hash.
"""

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm.text import LONG, STRING, array, free_name, in_small_batches, pick, struct
from tidemart.sources.scratch import materialise

WINDOW = 10
BLOCK = 200_000

#: A-Z lower-cased; every ASCII byte that is no letter or digit is a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _grams(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                tokens = words(text)
                n = min(size, len(tokens))
                rows += [(item, b" ".join(tokens[i:i + n])) for i in range(len(tokens) - n + 1)] if n else []
            yield pd.DataFrame(rows, columns=["item", "gram"])

    return run


class Grams:
    """One block of the benchmark: the n-grams as tuples of word numbers, and the items each belongs to."""

    def __init__(self, rows: list[tuple[str | None, bytes]]):
        self.ids: dict[bytes, int] = {}
        self.items: dict[bytes, list[str | None]] = {}
        self.lengths: list[int] = []
        lengths = set()
        for item, gram in rows:
            tokens = gram.split(b" ")
            lengths.add(len(tokens))
            coded = np.array([self.ids.setdefault(t, len(self.ids) + 1) for t in tokens], dtype=np.int32)
            self.items.setdefault(coded.tobytes(), []).append(item)
        self.lengths = sorted(lengths)

    def find(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Word ranges that some n-gram covers, merged, and the items found."""
        coded = np.fromiter(map(self.ids.get, tokens, repeat(0)), dtype=np.int32, count=len(tokens))
        known = np.concatenate(([0], np.cumsum(coded > 0)))
        ranges, found = [], set()
        for n in self.lengths:
            for at in np.flatnonzero(known[n:] - known[:-n] == n) if n <= len(tokens) else ():
                items = self.items.get(coded[at:at + n].tobytes())
                if items:
                    ranges.append((int(at), int(at) + n))
                    found.update(items)
        return merged(ranges), found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _in_order(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda item: (item is None, item or ""))


FOUND = struct(n_words=LONG, n_hit=LONG, spans=array(struct(start=LONG, end=LONG)), items=array(STRING))


def _scan(block):
    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = block.value
        for texts in batches:
            rows = []
            for text in texts:
                tokens = words(text)
                ranges, items = grams.find(tokens)
                spans = []
                if ranges:  # from word numbers to characters of the text
                    at = [m.span() for m in _WORD.finditer(text)]
                    spans = [{"start": at[low][0], "end": at[high - 1][1]} for low, high in ranges]
                rows.append((len(tokens), sum(high - low for low, high in ranges), spans, _in_order(items)))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "spans", "items"])

    return scan


@F.pandas_udf(FOUND)
def _joined(texts: pd.Series, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """The union of what two blocks found."""
    rows = []
    for text, n_words, a, b, x, y in zip(texts, old["n_words"], old["spans"], new["spans"], old["items"], new["items"]):
        spans = merged([(s["start"], s["end"]) for s in [*a, *b]])
        n_hit = sum(len(_WORD.findall(text, low, high)) for low, high in spans)
        rows.append((n_words, n_hit, [{"start": s, "end": e} for s, e in spans], _in_order({*x, *y})))
    return pd.DataFrame(rows, columns=["n_words", "n_hit", "spans", "items"])


def gram_blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int, block: int) -> tuple[DataFrame, int]:
    """The distinct (item, gram) pairs with a block number, and the number of blocks."""
    items = pick(benchmark, id_col, text_col).select(
        F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text")
    )
    pairs = items.mapInPandas(_grams(size), "item string, gram binary").distinct()
    pairs = materialise(pairs, "grams")
    blocks = max(1, -(-pairs.count() // block))
    return pairs.withColumn("block", F.pmod(F.xxhash64("item", "gram"), F.lit(blocks))), blocks


def with_hits(
    docs: DataFrame, benchmark: DataFrame, into: str, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """`docs` with the struct column `into`: `n_words`, `n_hit` words inside a benchmark window, character `spans` of
    the hits, and the `items` they come from, as sorted strings.

    NULL and empty texts, of documents and items, have no words and no hits. Items without id hit like others, and
    together stand as one NULL at the end of `items`. An item of fewer words than a window is one window as a whole. Repeated rows are scanned each for itself.
    """
    spark: SparkSession = in_small_batches(docs).sparkSession
    pairs, blocks = gram_blocks(benchmark, item_col, item_text_col, size, block)
    text = F.col(f"`{text_col}`")
    out = None
    for number in range(blocks):
        rows = [(r["item"], bytes(r["gram"])) for r in pairs.where(F.col("block") == number).toLocalIterator()]
        scan = _scan(spark.sparkContext.broadcast(Grams(rows)))
        if out is None:
            out = docs.withColumn(into, scan(text))
        else:
            out = materialise(out, "hits")
            out = out.withColumn(into, _joined(text, F.col(f"`{into}`"), scan(text)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, `n_words`, `n_hit`, `spans`, `items`. Other columns of `docs` are not read."""
    text_col = options.get("text_col", "text")
    found = with_hits(pick(docs, id_col, text_col), benchmark, "_hits", **options)
    return found.select(F.col(f"`{id_col}`").alias("doc_id"), "_hits.*")


@F.pandas_udf(STRING)
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, cuts in zip(texts, spans):
        for cut in reversed(list(cuts) if cuts is not None else []):
            text = text[:cut["start"]] + text[cut["end"]:]
        out.append(text)
    return pd.Series(out, dtype=object)


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "document", text_col: str = "text", **options) -> DataFrame:
    """`docs` without contaminated documents (`what="document"`), or without the hit spans (`what="span"`).

    The columns stay those of `docs`; with `span` every row stays and only the text of hit rows changes.
    """
    into = free_name(docs, "hits")
    found = with_hits(docs, benchmark, into, text_col=text_col, **options)
    if what == "document":
        return found.where(F.col(f"{into}.n_hit") == 0).drop(into)
    return found.withColumn(text_col, _cut(F.col(f"`{text_col}`"), F.col(f"{into}.spans"))).drop(into)
