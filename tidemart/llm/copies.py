"""Removal of passages that occur in an earlier document, through compressed FM-indexes of shards.

A window of `WIDTH` words has one smallest hash among its `GRAM`-word strings. Windows in a row that share it are a segment, and the
hash says which shard the segment belongs to: equal windows meet in one shard, whatever documents they come from. Of each text's
segments only those go further whose hash two documents hold, and of equal segments only one does. A shard builds an FM-index over
its segments, each owned by the smallest id that has it, and streams them through backward search; what comes back to a document is,
for each of its windows, the smallest id that holds the same words.

A hash with very many different segments would fill its shard. Its segments are cut into single windows, which are segments under
their own hash, and take the same way once more.

Documents travel as packs, and what packs and shards say to each other as one binary value per pack and shard. A pack names a
segment once however often it holds it, so a group of copies weighs as many entries as there are packs, not as there are copies.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.llm.fm import NOBODY, FMIndex
from tidemart.llm.packs import PACK, packed, texts, unpacked
from tidemart.llm.text import LONG, array, free_name, pick, struct
from tidemart.sources.scratch import materialise

WIDTH = 13
#: Words of the strings whose smallest hash deals windows to shards.
GRAM = 5
#: Windows of a segment, different segments of one hash in a pack and in a shard, and shards at least.
SPLIT, HERD, CROWD, SHARDS = 32, 64, 4096, 64
#: Bytes of a text that are split into words together.
PIECE = 1 << 22

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
NONE, HELD, SENT, SINGLE = 0, 1, 2, 3


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of about `PIECE` bytes that cut no word."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + PIECE)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space."""
    found = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) for words in (p.split() for p in pieces(text))]
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of `size` words."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + len(out)]
    return mixed(out)


class Segments:
    """Segments of the documents of a pack: `at` (place of the first word), `count` windows, `doc`, `anchor` and `kind` hashes."""

    def __init__(self, at, count, doc, anchor, kind):
        self.at, self.count, self.doc, self.anchor, self.kind = at, count, doc, anchor, kind


class Pack:
    """The words of a pack, with its segments and what it asks of shards. Texts with a NULL id take no part."""

    def __init__(self, rows: pa.RecordBatch, shards: int, herd: int):
        ids = rows["id"].to_pylist()
        self.texts, self.shards = texts(rows), shards
        hashes = [word_hashes(t) if i is not None else np.empty(0, np.uint64) for t, i in zip(self.texts, ids)]
        self.ids = np.array([i if i is not None else 0 for i in ids], np.int64)
        self.length = np.array([len(h) for h in hashes], np.int64)
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.whole = grams(self.words, WIDTH)
        self.level1 = self._runs()
        self.entries1 = Entries(self.level1, self.ids, shards, 0, herd)

    def _runs(self) -> Segments:
        doc = np.repeat(np.arange(len(self.length)), self.length)
        ends = np.cumsum(self.length)
        place = np.arange(len(self.whole))
        at = place[place + WIDTH <= ends[doc[:len(place)]]]
        if not len(at):
            none = np.empty(0, np.int64)
            return Segments(none, none, none, none.view(np.uint64), none.view(np.uint64))
        small = grams(self.words, GRAM)
        least = small[:len(place)].copy()
        for i in range(1, WIDTH - GRAM + 1):
            np.minimum(least, small[i:i + len(place)], out=least)
        anchor = least[at]
        new = np.concatenate(([True], (np.diff(at) != 1) | (anchor[1:] != anchor[:-1])))
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= since % SPLIT == 0
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        inside = (np.arange(len(at)) - np.repeat(first, count)).astype(np.uint64)
        kind = mixed(np.add.reduceat(mixed(self.whole[at] ^ mixed(inside + np.uint64(1))), first)) | np.uint64(1)
        return Segments(at[first], count, doc[at[first]], anchor[first], kind)

    def singles(self, which: np.ndarray) -> Segments:
        """The windows of some segments, each as a segment under its own hash."""
        parts = self.level1
        count = parts.count[which]
        begin = np.cumsum(count) - count
        at = np.repeat(parts.at[which] - begin, count) + np.arange(int(count.sum()))
        whole = self.whole[at]
        return Segments(at, np.ones(len(at), np.int64), np.repeat(parts.doc[which], count), whole, whole | np.uint64(1))


class Entries:
    """The different segments of a pack in the order of their shards: `shard`, `anchor`, `kind`, `low` and `high` id, and `of`, which
    entry each segment is. An anchor with more than `herd` kinds is one entry of kind 0."""

    def __init__(self, parts: Segments, ids: np.ndarray, shards: int, first_shard: int, herd: int):
        shard = first_shard + (mixed(parts.anchor) % np.uint64(shards)).astype(np.int64)
        kind = parts.kind
        self.of = np.empty(len(kind), np.int64)
        if not len(kind):
            self.shard = self.low = self.high = self.rows = self.of
            self.anchor = self.kind = kind
            return
        for _ in range(2):
            order = np.lexsort((kind, parts.anchor, shard))
            a, k = parts.anchor[order], kind[order]
            new = np.concatenate(([True], (a[1:] != a[:-1]) | (k[1:] != k[:-1])))
            of_anchor = runs_of(a)
            kinds = np.bincount(of_anchor[new])
            large = kinds[of_anchor] > herd
            if not large.any():
                break
            kind = kind.copy()
            kind[order[large]] = 0
        first = np.flatnonzero(new)
        self.of[order] = np.cumsum(new) - 1
        own = ids[parts.doc][order]
        self.rows = order[first]  # a segment for each entry
        self.shard, self.anchor, self.kind = shard[self.rows], a[first], k[first]
        self.low, self.high = np.minimum.reduceat(own, first), np.maximum.reduceat(own, first)

    def by_shard(self) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.diff(self.shard, prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(self.shard)]):
            yield int(self.shard[low]), slice(int(low), int(high))


def runs_of(key: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((np.zeros(1, np.int64), (key[1:] != key[:-1]).astype(np.int64))))


def sealed(*columns: np.ndarray) -> bytes:
    """Columns of 64 bits as one compressed value."""
    head = np.array([len(columns), *map(len, columns)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in (head, *columns)))


def opened(body: bytes) -> list[np.ndarray]:
    """The columns again; hashes are to be viewed as unsigned."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.int64)
    cuts = 1 + int(data[0]) + np.cumsum(np.concatenate(([0], data[1:1 + int(data[0])])))
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


ASKS = "shard long, pack long, body binary"


def _asked(entries: Entries, pack: int) -> pd.DataFrame:
    out = [
        (shard, pack, sealed(entries.anchor[s], entries.kind[s], entries.low[s], entries.high[s] - entries.low[s]))
        for shard, s in entries.by_shard()
    ]
    return pd.DataFrame(out, columns=["shard", "pack", "body"])


def _asks(shards: int, herd: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pack, body in zip(batch["pack"], batch["body"]):
                yield _asked(Pack(unpacked(body), shards, herd).entries1, pack)

    return run


PLAN = "shard long, pack long, singles boolean, body binary"


def _decided(crowd: int):
    """For each pack what happens to its entries, and which of the shard's segments they are."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        asked = [opened(b) for b in group["body"]]
        size = [len(a[0]) for a in asked]
        anchor, kind, low, more = (np.concatenate([a[i] for a in asked]) for i in range(4))
        anchor, kind = anchor.view(np.uint64), kind.view(np.uint64)
        pack = np.repeat(group["pack"].to_numpy(), size)
        order = np.lexsort((pack, low, kind, anchor))
        a, k = anchor[order], kind[order]
        of = runs_of(a)
        edges = np.flatnonzero(np.diff(of, prepend=-1))
        shared = np.minimum.reduceat(low[order], edges) < np.maximum.reduceat((low + more)[order], edges)
        first = np.concatenate(([True], (a[1:] != a[:-1]) | (k[1:] != k[:-1])))
        crowded = (np.bincount(of[first]) > crowd) | (k[edges] == 0)
        state = np.where(first, SENT, HELD)
        state[crowded[of]] = SINGLE
        state[~shared[of]] = NONE
        number = np.cumsum(state == SENT) - 1
        out_state, out_number = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        out_state[order], out_number[order] = state, np.where((state == SENT) | (state == HELD), number, -1)
        cuts = np.cumsum([0, *size])
        rows = []
        for i, (name, lo, hi) in enumerate(zip(group["pack"], cuts, cuts[1:])):
            if out_state[lo:hi].any():
                rows.append((group["shard"].iloc[0], name, bool((out_state[lo:hi] == SINGLE).any()), sealed(out_state[lo:hi], out_number[lo:hi])))
        return pd.DataFrame(rows, columns=["shard", "pack", "singles", "body"])

    return run


def _states(entries: Entries, plan: pd.DataFrame) -> np.ndarray:
    """What the shards said of each entry."""
    state = np.zeros(len(entries.shard), np.int64)
    said = dict(zip(plan["shard"], plan["body"]))
    for shard, s in entries.by_shard():
        if shard in said:
            state[s] = opened(said[shard])[0]
    return state


def _single_entries(pack: Pack, state: np.ndarray, shards: int) -> tuple[Segments, Entries]:
    which = np.flatnonzero(state[pack.entries1.of] == SINGLE) if len(state) else np.empty(0, np.int64)
    parts = pack.singles(which)
    return parts, Entries(parts, pack.ids, shards, shards, 1 << 62)


def _asks_again(shards: int, herd: int):
    def run(packs: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        if not len(packs):
            return pd.DataFrame(columns=["shard", "pack", "body"])
        pack = Pack(unpacked(packs["body"].iloc[0]), shards, herd)
        entries = _single_entries(pack, _states(pack.entries1, plan), shards)[1]
        return _asked(entries, packs["pack"].iloc[0])

    return run


SHIPPED = "shard long, body binary"


def _ships(shards: int, herd: int):
    """The words of the segments that this pack sends to their shards."""

    def run(packs: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(packs) and len(plan):
            pack = Pack(unpacked(packs["body"].iloc[0]), shards, herd)
            state = _states(pack.entries1, plan)
            levels = [(pack.level1, pack.entries1, state)]
            if plan["singles"].any():
                parts, entries = _single_entries(pack, state, shards)
                levels.append((parts, entries, _states(entries, plan)))
            for parts, entries, said in levels:
                for shard, s in entries.by_shard():
                    sent = s.start + np.flatnonzero(said[s] == SENT)
                    if len(sent):
                        rows = entries.rows[sent]
                        length = parts.count[rows] + WIDTH - 1
                        begin = np.cumsum(length) - length
                        words = pack.words[np.repeat(parts.at[rows] - begin, length) + np.arange(int(length.sum()))]
                        out.append((shard, sealed(entries.anchor[sent], entries.kind[sent], entries.low[sent], length, words)))
        return pd.DataFrame(out, columns=["shard", "body"])

    return run


ANSWERS = "shard long, pack long, singles boolean, body binary, owners binary"


def _answers(plan: pd.DataFrame, shipped: pd.DataFrame) -> pd.DataFrame:
    """A shard: the index of its segments, the segments streamed through it, and for each pack the owners of its windows."""
    names = ["shard", "pack", "singles", "body", "owners"]
    if not len(plan):
        return pd.DataFrame(columns=names)
    if len(shipped):
        sent = [opened(b) for b in shipped["body"]]
        anchor, kind = (np.concatenate([s[i] for s in sent]).view(np.uint64) for i in (0, 1))
        owner, length, words = (np.concatenate([s[i] for s in sent]) for i in (2, 3, 4))
        order = np.lexsort((kind, anchor))
        begin = np.cumsum(length) - length
        length = length[order]
        start = np.cumsum(length) - length
        words = words.view(np.uint64)[np.repeat(begin[order] - start, length) + np.arange(int(length.sum()))]
        index = FMIndex(words, length, owner[order], WIDTH)
        owners, count = index.owners(words, length), length - WIDTH + 1
        start = np.cumsum(count) - count
    out = []
    for row in plan.itertuples(index=False):
        number = opened(row.body)[1]
        number = number[number >= 0]
        if len(number):
            size = count[number]
            begin = np.cumsum(size) - size
            found = owners[np.repeat(start[number] - begin, size) + np.arange(int(size.sum()))]
        else:
            found = np.empty(0, np.int64)
        out.append((row.shard, row.pack, row.singles, row.body, sealed(found)))
    return pd.DataFrame(out, columns=names)


def _removed(pack: Pack, parts: Segments, entries: Entries, answers: pd.DataFrame) -> np.ndarray:
    """Places of windows that an earlier document holds."""
    said = {a.shard: a for a in answers.itertuples(index=False)}
    owner_at = np.full(len(entries.shard), -1)  # where the owners of an entry's windows begin
    held, total = [], 0
    for shard, s in entries.by_shard():
        if shard in said:
            state = opened(said[shard].body)[0]
            owners = opened(said[shard].owners)[0]
            known = s.start + np.flatnonzero((state == HELD) | (state == SENT))
            size = parts.count[entries.rows[known]]
            owner_at[known] = total + np.cumsum(size) - size
            held.append(owners)
            total += len(owners)
    known = np.flatnonzero(owner_at[entries.of] >= 0) if len(entries.of) else np.empty(0, np.int64)
    if not len(known):
        return known
    owners = np.concatenate(held)
    count = parts.count[known]
    begin = np.cumsum(count) - count
    step = np.arange(int(count.sum()))
    at = np.repeat(parts.at[known] - begin, count) + step
    owner = owners[np.repeat(owner_at[entries.of[known]] - begin, count) + step]
    return at[owner < np.repeat(pack.ids[parts.doc[known]], count)]


def _kept(text: bytes, gone: np.ndarray) -> tuple[int, str, bytes]:
    """The number of words, and hash and text of those that stay."""
    digest, out, at, some = hashlib.sha256(), [], 0, False
    for piece in pieces(text):
        words = piece.split()
        if len(gone):
            words_kept = [w for w, g in zip(words, gone[at:at + len(words)].tolist()) if not g]
        else:
            words_kept = words
        at += len(words)
        if words_kept:
            part = (b" " if some else b"") + b" ".join(words_kept)
            digest.update(part)
            out.append(part)
            some = True
    return at, digest.hexdigest(), b"".join(out)


def _finished(shards: int, herd: int, kind, name: str):
    schema = StructType([
        StructField(name, kind), StructField("n_words", LONG), StructField("n_removed", LONG), StructField("kept_sha256", StringType()),
        StructField("spans", array(struct(low=LONG, high=LONG))), StructField("kept", StringType()),
    ])

    def run(packs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = unpacked(packs["body"].iloc[0])
        pack = Pack(rows, shards, herd)
        removed = _removed(pack, pack.level1, pack.entries1, answers)
        if len(answers) and answers["singles"].any():
            parts, entries = _single_entries(pack, _states(pack.entries1, answers), shards)
            removed = np.concatenate((removed, _removed(pack, parts, entries, answers)))
        change = np.zeros(len(pack.words) + 1, np.int64)
        np.add.at(change, removed, 1)
        np.add.at(change, removed + WIDTH, -1)
        gone = np.cumsum(change)[:-1] > 0
        ends = np.cumsum(pack.length)
        out = []
        for text, low, high in zip(pack.texts, ends - pack.length, ends):
            part = gone[low:high]
            if not part.any():
                part = part[:0]
            edges = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0))
            n, digest, kept = _kept(text, part)
            out.append((n, int(part.sum()), digest, [{"low": int(a), "high": int(b)} for a, b in edges.reshape(-1, 2)],
                        kept.decode("utf-8", "surrogatepass")))
        out = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "spans", "kept"])
        out.insert(0, name, pd.Series(rows["id"].to_pylist(), dtype=object))
        return out

    return run, schema


def without_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack: int = PACK, herd: int = HERD, crowd: int = CROWD,
    shards: int | None = None,
) -> DataFrame:
    """One row per row of `docs`: the id, `n_words`, `n_removed`, `kept_sha256`, `spans` of removed words, and `kept`, the text left.

    A word goes if a window of `WIDTH` words covers it that also starts in a document with a smaller id; ids are whole numbers.
    Windows never cross documents and are judged on the input. Repeats inside a document and between rows of one id stay. NULL, empty
    and short texts lose nothing. A row without id is neither smaller nor larger than another: it loses nothing and takes nothing.
    An empty table gives no rows. Other columns are left out. `pack`, `herd`, `crowd` and `shards` change the work, not the result.
    """
    rows = pick(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    packs = packed(rows, pack)
    shards = shards or max(SHARDS, packs.count())

    def plan_of(asks: DataFrame) -> DataFrame:
        return materialise(asks.groupBy("shard").applyInPandas(_decided(crowd), PLAN), "plan")

    plan = plan_of(packs.mapInPandas(_asks(shards, herd), ASKS))
    by_pack = packs.groupBy("pack")
    if not plan.where("singles").isEmpty():
        plan = plan.unionByName(plan_of(by_pack.cogroup(plan.groupBy("pack")).applyInPandas(_asks_again(shards, herd), ASKS)))
    shipped = by_pack.cogroup(plan.groupBy("pack")).applyInPandas(_ships(shards, herd), SHIPPED)
    answers = materialise(plan.groupBy("shard").cogroup(shipped.groupBy("shard")).applyInPandas(_answers, ANSWERS), "owners")
    run, schema = _finished(shards, herd, rows.schema["id"].dataType, id_col)
    return by_pack.cogroup(answers.groupBy("pack")).applyInPandas(run, schema)
