"""Language-model scores by prediction by partial matching, with a word unigram model beside it.

The PPM model is a trie of byte contexts up to `order` bytes long (four unless told otherwise), counted over all training
documents: escape estimation by the number of distinct symbols (method C), with symbol exclusion. A text's score is the log10 probability of its bytes
and its end.

Neither the trie nor the vocabulary is ever held in one place. Documents are packed, several MB to a row. A pack sends the
distinct strings of `order` + 1 bytes and word hashes in it, with training counts, to buckets; a bucket, which owns all contexts with
the same last two bytes, merges counts and computes probabilities; each pack gets back the values of exactly the strings it
asked for. Only the contexts of one byte, at most 65,536 counts, are shared with every task.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tidemart.llm.packs import PACK, packed, texts, unpacked
from tidemart.llm.text import BOOLEAN, DOUBLE, LONG, pick
from tidemart.sources.scratch import materialise

#: Bytes scored at once, and packs whose distinct strings make up one bucket on average.
CHUNK, PACKS_PER_BUCKET = 1 << 20, 3
#: Packs that are answered by one copy of a bucket.
PACKS_PER_GROUP = 256
#: Two bytes that UTF-8 never has: before each text, and its end.
PAD, END = 0xFE, 0xFF
#: The longest context of the model by default, and the longest that fits into a code with its symbol.
ORDER, LONGEST = 4, 7
SYMBOLS = 255

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END_TOKEN = b" end"  # words have no spaces


def code_kind(order: int):
    """The type of a symbol's code: the bytes of its context, then the symbol."""
    return np.uint32 if order <= 3 else np.uint64


class Pack:
    """The documents of one pack."""

    def __init__(self, body: bytes):
        rows = unpacked(body)
        self.ids, self.held, self.texts = rows["id"], rows["held_out"].to_pylist(), texts(rows)

    def words(self) -> Iterator[tuple[bool, list[bytes]]]:
        """Per document: whether it is held out, and its tokens."""
        for held, text in zip(self.held, self.texts):
            yield held, [*text.translate(_LOWER).split(), _END_TOKEN]

    def codes(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """Chunks of documents: the code of every symbol with its context, where each document's codes begin, and the
        numbers of the documents."""
        group: list[int] = []
        size, kind = 0, code_kind(order)
        for i, text in enumerate(self.texts):
            group.append(i)
            size += len(text)
            if size >= CHUNK or i == len(self.texts) - 1:
                data = b"".join(bytes([PAD] * order) + self.texts[j] + bytes([END]) for j in group)
                a = np.frombuffer(data, np.uint8)
                codes = a[:-order].astype(kind)
                for n in range(1, order + 1):
                    codes = (codes << kind(8)) | a[n:len(a) - order + n]
                codes = codes[a[order:] != PAD]
                lengths = np.array([len(self.texts[j]) + 1 for j in group])
                yield codes, np.concatenate(([0], np.cumsum(lengths)[:-1])), group
                group, size = [], 0


def _bucket_of_codes(codes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of codes: by the last two bytes of the context."""
    return ((((codes >> 8) & 0xFFFF).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)


def _word_hashes(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and buckets of distinct words, and the order by bucket and hash."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return hashes, bucket, np.lexsort((hashes, bucket))


ASKED = "pack long, bucket long, keys binary, counts binary"


def _rows(pack: int, bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """One row per bucket of values in bucket order."""
    ends = np.flatnonzero(np.diff(bucket)) + 1
    rows = [
        (pack, int(bucket[a]), keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes())  # a pack has fewer symbols
        for a, b in zip([0, *ends], [*ends, len(bucket)]) if a < b
    ]
    return pd.DataFrame(rows, columns=["pack", "bucket", "keys", "counts"])


def _ask_words(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, body in zip(batch["pack"], batch["body"]):
                train, seen = Counter(), set()
                for held, tokens in Pack(body).words():
                    (seen if held else train).update(tokens)
                words = list(train.keys() | seen)
                hashes, bucket, order = _word_hashes(words, buckets)
                counts = np.fromiter((train.get(w, 0) for w in words), np.int64, len(words))
                yield _rows(number, bucket[order], hashes[order], counts[order])

    return run


def _ask_codes(buckets: int, order: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, body in zip(batch["pack"], batch["body"]):
                pack, found, numbers = Pack(body), [], []
                for codes, starts, group in pack.codes(order):
                    ends = [*starts[1:], len(codes)]
                    train = np.ones(len(codes), np.int64)
                    for a, b, i in zip(starts, ends, group):
                        if pack.held[i]:
                            train[a:b] = 0
                    for part, n in ((codes[train == 1], 1), (codes[train == 0], 0)):
                        keys, times = np.unique(part, return_counts=True)
                        found.append(keys)
                        numbers.append(times * n)
                keys, counts = _summed(found, numbers)
                bucket = _bucket_of_codes(keys, buckets)
                at = np.lexsort((keys, bucket))
                yield _rows(number, bucket[at], keys[at], counts[at])

    return run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    if not keys:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, places, np.concatenate(counts))
    return distinct, total


def _merge(kind, count_kind=np.int64):
    """Rows of one bucket to one row with the distinct keys and total counts."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _summed(
            [np.frombuffer(k, kind) for k in group["keys"]], [np.frombuffer(c, count_kind) for c in group["counts"]]
        )
        return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "keys": [keys.tobytes()], "counts": [counts.tobytes()]})

    return run


def _merged(asked: DataFrame, kind) -> DataFrame:
    """One row per bucket. Rows are merged in two steps, so a bucket that every pack asks is no single task's work."""
    schema = "bucket long, keys binary, counts binary"
    part = asked.select("bucket", "keys", "counts", F.pmod(F.xxhash64("pack"), F.lit(64)).alias("part"))
    part = part.groupBy("bucket", "part").applyInPandas(_merge(kind, np.uint32), schema)
    return part.groupBy("bucket").applyInPandas(_merge(kind), schema)


def _first_order(kind):
    """Counts of (context byte, symbol)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"]):
                pair = (np.frombuffer(keys, kind) & kind(0xFFFF)).astype(np.int64)
                total = np.bincount(pair, np.frombuffer(counts, np.int64), 1 << 16).astype(np.int64)
                at = np.flatnonzero(total)
                yield pd.DataFrame({"pair": at, "n": total[at]})

    return run


def log_probabilities(codes: np.ndarray, counts: np.ndarray, first: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 P(last byte | the `order` bytes before it) of each code.

    `codes` are distinct and hold every trained code of their two-byte contexts, `counts` the training counts (0 for codes
    that are only asked for), `first` the counts of (context byte, symbol) over the whole training text.
    """
    codes = codes.astype(np.uint64)
    last, symbol = ((codes >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64), (codes & np.uint64(0xFF)).astype(np.int64)
    levels = []  # by context: count of the symbol, total and kinds of the symbols not seen in a longer context
    longer = excluded = None  # each code's place among those of the level before, and kinds of its context there
    for n in range(order, 1, -1):
        strings, place = np.unique(codes & np.uint64((1 << 8 * (n + 1)) - 1), return_inverse=True)
        count = np.bincount(place, counts)
        _, context = np.unique(strings >> np.uint64(8), return_inverse=True)
        total, kinds = np.bincount(context, count)[context], np.bincount(context, count > 0)[context]
        if longer is None:
            levels.append((count[place], total[place], kinds[place]))
        else:
            shadowed = _shadowed(longer, count[place])
            levels.append((count[place], total[place] - shadowed, kinds[place] - excluded))
        longer, excluded = (place, context, count), kinds[place]
    zero = first.sum(axis=0)
    seen0 = zero > 0
    kinds1 = (first > 0).sum(axis=1)[last]
    levels.append((
        first[last, symbol], first.sum(axis=1)[last] - _shadowed(longer, first[last, symbol]), kinds1 - excluded,
    ))
    levels.append((zero[symbol], zero.sum() - ((first > 0) * zero).sum(axis=1)[last], seen0.sum() - kinds1))

    p, alive = np.zeros(len(codes)), np.ones(len(codes))
    open_ = np.ones(len(codes), dtype=bool)
    for n, total, kinds in levels:
        weight = np.maximum(total + kinds, 1)
        hit = open_ & (n > 0)
        p[hit] = (alive * n / weight)[hit]
        open_ &= ~hit
        alive = np.where(total > 0, alive * kinds / weight, alive)
    p[open_] = alive[open_] / max(1, SYMBOLS - int(seen0.sum()))
    return np.log10(p)


def _shadowed(longer: tuple[np.ndarray, np.ndarray, np.ndarray], shorter: np.ndarray) -> np.ndarray:
    """For each code, how often the symbols seen in its longer context occur in its shorter one. `shorter`: each code's count there."""
    place, context, count = longer
    each = np.zeros(len(count))
    each[place] = shorter  # codes of one string share the shorter context and the symbol
    return np.bincount(context, (count > 0) * each)[context][place]


VALUES = "bucket long, keys binary, values binary"


def _model(first, order: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, keys, counts in zip(batch["bucket"], batch["keys"], batch["counts"]):
                codes = np.frombuffer(keys, code_kind(order))
                values = log_probabilities(codes, np.frombuffer(counts, np.int64), first.value, order)
                yield pd.DataFrame({"bucket": [bucket], "keys": [keys], "values": [values.tobytes()]})

    return run


def _answer(kind, value_kind, with_keys: bool):
    """The values of the keys that packs ask one bucket for, in the order asked."""

    def run(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame({"pack": [], "bucket": [], "keys": [], "values": []})
        all_keys = np.frombuffer(known["keys"].iloc[0], kind)
        values = np.frombuffer(known["values"].iloc[0], value_kind)
        found = [values[np.searchsorted(all_keys, np.frombuffer(k, kind))].tobytes() for k in asked["keys"]]
        return pd.DataFrame({
            "pack": asked["pack"], "bucket": asked["bucket"], "keys": asked["keys"] if with_keys else None, "values": found,
        })

    return run


def _answers(
    asked: DataFrame, known: DataFrame, kind, value_kind, label: str, copies: int, with_keys: bool = True,
) -> DataFrame:
    """What each pack asked for: (pack, bucket, what, keys, values). Without keys, packs know the order in which they asked.

    Each bucket of `known` is there in `copies`, and each pack asks one of them, so that a bucket that every pack asks is
    many groups, of some `PACKS_PER_GROUP` packs each.
    """
    asked = asked.select("pack", "bucket", "keys", F.pmod(F.xxhash64("pack"), F.lit(copies)).cast("int").alias("copy"))
    known = known.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = asked.groupBy("bucket", "copy").cogroup(known.groupBy("bucket", "copy"))
    got = rows.applyInPandas(_answer(kind, value_kind, with_keys), "pack long, bucket long, keys binary, values binary")
    return got.withColumn("what", F.lit(label))


def _sorted_answers(answers: pd.DataFrame, what: str, kind, value_kind) -> tuple[np.ndarray, np.ndarray]:
    """The keys of one kind in order, with their values."""
    part = answers[answers["what"] == what]
    keys = np.concatenate([np.frombuffer(k, kind) for k in part["keys"]])
    values = np.concatenate([np.frombuffer(v, value_kind) for v in part["values"]])
    order = np.argsort(keys)
    return keys[order], values[order]


def _score(tokens: int, kinds: int, order: int, buckets: int):
    floor = np.log10(tokens + 0.5 * (kinds + 1)) if tokens else 0.0
    unknown = float(np.log10(0.5) - floor)

    def run(packs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        pack = Pack(packs["body"].iloc[0])
        parts = answers[answers["what"] == "words"].sort_values("bucket")["values"]
        counts = np.concatenate([np.frombuffer(v, np.int64) for v in parts])
        values = np.where(counts > 0, np.log10(counts + 0.5) - floor, unknown)
        seen: set[bytes] = set()
        for _, part in pack.words():
            seen.update(part)
        words = list(seen)
        _, _, asked = _word_hashes(words, buckets)
        base = {words[i]: value for i, value in zip(asked.tolist(), values.tolist())}
        rows = []
        for _, part in pack.words():
            found = list(map(base.__getitem__, part))
            rows.append((len(part), len(part) - found.count(unknown), sum(found)))
        del base, seen, words
        distinct, values = _sorted_answers(answers, "codes", code_kind(order), np.float64)
        scores = np.zeros(len(pack.texts))
        for codes, starts, group in pack.codes(order):
            part, places = np.unique(codes, return_inverse=True)
            scores[group] = np.add.reduceat(values[np.searchsorted(distinct, part)][places], starts)
        return pd.DataFrame({
            "doc_id": pd.Series(pack.ids.to_pylist(), dtype=object), "held_out": pack.held, "n_tokens": [r[0] for r in rows],
            "n_known": [r[1] for r in rows], "train_tokens": tokens, "base_score": [r[2] for r in rows], "score": scores,
            "n_bytes": [len(t) for t in pack.texts],
        })

    return run


def scores(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", pack: int = PACK, order: int = ORDER,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`,
    `n_bytes`.

    Both models learn from the rows where `held_out` is not true and score all rows. NULL texts are empty: one token,
    the end. Repeated rows count each. Without training rows every byte is equally likely and `base_score` knows no token.
    An empty table gives no rows. `order`, 2 to 7, is the length of the longest context; longer ones cost more strings.
    """
    if not 2 <= order <= LONGEST:
        raise ValueError(f"order must be 2 to {LONGEST}")
    kind = code_kind(order)
    rows = pick(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    packs = packed(rows, pack)
    n_packs = packs.count()
    n_buckets, copies = max(1, -(-n_packs // PACKS_PER_BUCKET)), max(1, -(-n_packs // PACKS_PER_GROUP))

    code_buckets = min(n_buckets, 1 << 12)
    words = materialise(packs.mapInPandas(_ask_words(n_buckets), ASKED), "asked-words")
    vocabulary = materialise(_merged(words, np.uint64), "vocabulary")
    totals = vocabulary.mapInPandas(_totals, "tokens long, kinds long").agg(F.sum("tokens"), F.sum("kinds")).first()
    tokens, kinds = totals[0] or 0, totals[1] or 0
    codes = materialise(packs.mapInPandas(_ask_codes(code_buckets, order), ASKED), "asked-codes")
    trie = materialise(_merged(codes, kind), "trie")
    first = np.zeros((256, 256), np.int64)
    for row in trie.mapInPandas(_first_order(kind), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        first[row["pair"] >> 8, row["pair"] & 0xFF] = row["n"]  # at most 65,536 rows
    model = trie.mapInPandas(_model(docs.sparkSession.sparkContext.broadcast(first), order), VALUES)

    answers = _answers(
        words, vocabulary.withColumnRenamed("counts", "values"), np.uint64, np.int64, "words", copies, with_keys=False
    ).unionByName(_answers(codes, model, kind, np.float64, "codes", copies))
    schema = StructType([
        StructField("doc_id", rows.schema["id"].dataType), StructField("held_out", BOOLEAN), StructField("n_tokens", LONG),
        StructField("n_known", LONG), StructField("train_tokens", LONG), StructField("base_score", DOUBLE),
        StructField("score", DOUBLE), StructField("n_bytes", LONG),
    ])
    return (
        packs.groupBy("pack").cogroup(answers.groupBy("pack"))
        .applyInPandas(_score(tokens, kinds, order, n_buckets), schema)
    )


def _totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = [np.frombuffer(c, np.int64) for c in batch["counts"]]
        yield pd.DataFrame({"tokens": [int(c.sum()) for c in counts], "kinds": [int((c > 0).sum()) for c in counts]})
