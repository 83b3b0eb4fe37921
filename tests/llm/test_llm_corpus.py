"""Operators that compare documents: near-duplicates, repeated strings, language-model scores, components, pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import near, ppm, repeats
from tidemart.llm.components import components
from tidemart.llm.sieve import sieve

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200), (None, 5), (6, None)]
    edges += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)] + [(0, 1)]
    union = Union()
    for a, b in edges:
        if a is not None and b is not None:
            union.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x in union.parent if union.find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, size):
    words = (text or "").encode().translate(LOWER).split()
    n = len(words)
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, n - size + 1))) if n else frozenset()


def brute_groups(rows, size):
    sets = [(d, shingles(t, size)) for d, t in rows]
    union = Union()
    for i, (a, x) in enumerate(sets):
        union.find(a)
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                union.join(a, b)
    return {d: (len(s), union.find(d), union.find(d) == d) for d, s in sets}


def near_rows(count=60):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(count):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 5, 8, 40, 120, 300)))]
        for _ in range(rng.choice((1, 1, 2, 6))):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4, 8))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((number, " ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy)))
            number += 1
    # a chain, in which only neighbours are similar, and a large group around one passage
    long = [rng.choice(vocabulary) for _ in range(200)]
    for i in range(40):
        rows.append((number, " ".join(long[i * 2:i * 2 + 100])))
        number += 1
    for i in range(60):
        rows.append((number, " ".join(long + [f"own{i}x{j}" for j in range(i % 30 * 2)])))
        number += 1
    rng.shuffle(rows)
    return rows + [(10_000, None), (10_001, ""), (10_002, " \n "), (10_003, "one"), (10_004, "ONE"), (10_005, "one two")]


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups_equal_brute_force(spark, size):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, component_id string, path int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.groups(docs, size=size).collect()}
    assert got == brute_groups(rows, size)
    kept = near.deduplicate(docs, size=size)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, v in got.items() if v[2])


def test_near_rows_without_id_and_repeated_rows(spark):
    text = "a text of some words that is long enough to have several shingles in it"
    docs = spark.createDataFrame([(None, text), (None, text), (5, text), (5, text), (9, text), (7, "x")], "doc_id long, text string")
    got = sorted(map(tuple, near.groups(docs).collect()), key=str)
    assert Counter(r[2] for r in got) == {5: 3, None: 2, 7: 1} and all(r[3] for r in got if r[0] != 9)
    assert Counter(r["doc_id"] for r in near.deduplicate(docs).collect()) == {None: 2, 5: 1, 7: 1}
    assert near.groups(docs.limit(0)).count() == 0 and near.deduplicate(docs.limit(0)).count() == 0


def test_sieve_loses_no_id(spark):
    ids = spark.range(0, 90_000, 3).union(spark.createDataFrame([(None,)], "id long"))
    found = spark.range(100_000).where(sieve(ids, "id")(F.col("id")))
    assert found.where("id < 90000 AND id % 3 = 0").count() == 30_000 and found.count() < 36_000
    assert spark.range(9).where(sieve(ids.limit(0), "id")(F.col("id"))).count() == 0


def brute_repeats(texts):
    n, counts = repeats.LENGTH, Counter()
    for t in texts:
        counts.update(t[i:i + n] for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if counts[t[i:i + n]] > 1:
                gone[i:i + n] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij éß ") for _ in range(n))
    shared = [noise(n) for n in (399, 400, 401, 650, 3000)]
    texts = [noise(rng.randrange(2000)) + rng.choice(shared) + noise(rng.randrange(900)) for _ in range(40)]
    texts += [shared[4][:700], shared[4][300:1100], shared[4][i:i + 450] and "x" + shared[4][5:405], shared[1], shared[1][:399]] if (i := 7) else []
    near_copies = list(noise(1500))
    for _ in range(30):
        near_copies[rng.randrange(1500)] = "#"
        texts.append("".join(near_copies))
    texts += ["z" * 1000, "ab" * 900, "long line of text that repeats \n" * 60, noise(2500) * 2, "", noise(400), "é" * 450]
    texts += [texts[0]] * 4
    return texts


def test_repeats_equal_brute_force(spark):
    texts = repeat_texts()
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, None, "n"), (3, "short", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anchor string").repartition(3)
    expected = brute_repeats([(t or "").encode() for _, t, _ in rows])
    got = repeats.without_repeats(docs, pack=20_000).collect()
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=key) == sorted(
        ((d, *e) for (d, _, _), e in zip(rows, expected)), key=key)
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_repeats_of_crowded_anchors_take_the_exact_way(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 3)
    texts = repeat_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.without_repeats(docs).collect()}
    assert got == dict(enumerate(brute_repeats([t.encode() for t in texts])))


def test_crowded_anchors_keep_text_beside_a_run(spark, monkeypatch):
    """Every place of a run is an anchor of one hash, so contexts of one place hold the same strings."""
    rng = random.Random(8)
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = [noise() + "z" * 500 + noise(), noise() + "xy" * 250 + noise(), noise() + "z" * 390 + noise()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = dict(enumerate(brute_repeats([t.encode() for t in texts])))
    for crowd in (3, repeats.CROWD):
        monkeypatch.setattr(repeats, "CROWD", crowd)
        rows = repeats.without_repeats(docs).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == expected


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    data = random.Random(1).randbytes(9000)
    whole = repeats.anchors(data)
    monkeypatch.setattr(repeats, "PIECE", 1000)
    for a, b in zip(whole, repeats.anchors(data)):
        assert np.array_equal(a, b)


def test_merged_transform_is_that_of_all_strings():
    rng = np.random.default_rng(2)
    strings = 20 + rng.integers(0, 3, (9, 12))
    depth = 12
    parts = [repeats.transform(strings[i:i + 3], i) for i in range(0, 9, 3)]
    whole = repeats.merge_all(parts, depth)
    suffix = {(s, a): tuple(strings[s, a:]) + (s,) for s in range(9) for a in range(13)}
    order = sorted(suffix, key=suffix.get)
    assert list(zip(whole.string.tolist(), whole.at.tolist())) == order
    for (x, y), step in zip(zip(order, order[1:]), np.diff(whole.block)):
        common = next(i for i, (p, q) in enumerate(zip(suffix[x], suffix[y])) if p != q)
        assert (step == 0) == (common >= depth)


def brute_ppm(train, text, order=ppm.ORDER):
    """PPM with method C and exclusion, one symbol at a time."""
    counts, pad = defaultdict(Counter), bytes([ppm.PAD] * order)
    for t in train:
        data = pad + t + bytes([ppm.END])
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k:i]][data[i]] += 1
    total, data = 0.0, pad + text + bytes([ppm.END])
    for i in range(order, len(data)):
        p, excluded = 1.0, set()
        for k in range(order, -1, -1):
            here = {s: n for s, n in counts[data[i - k:i]].items() if s not in excluded}
            weight = sum(here.values()) + len(here)
            if data[i] in here:
                p *= here[data[i]] / weight
                break
            if here:
                p *= len(here) / weight
            excluded |= here.keys()
        else:
            p /= ppm.SYMBOLS - len(excluded)
        total += math.log10(p)
    return total


def test_scores_equal_brute_force(spark):
    rng = random.Random(4)
    words = ["the", "cat", "Sat", "on", "mat", "é", "zebra!", "\t"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "qqq \x00 new"), (None, "no id"), (5, rows[5][1]), (83, "the cat " * 5000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(2)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    column = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    got = sorted(ppm.scores(docs, column, pack=500).collect(), key=lambda r: str((r["doc_id"], r["n_bytes"])))
    tokens = lambda t: [*(t or "").encode().translate(LOWER).split(), "END"]
    train = [t for d, t in rows if not held(d)]
    counts = Counter(x for t in train for x in tokens(t))
    n, kinds = sum(counts.values()), len(counts)
    rows.sort(key=lambda r: str((r[0], len((r[1] or "").encode()))))
    for r, (d, t) in zip(got, rows, strict=True):
        own = tokens(t)
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (d, held(d), len(own), n)
        assert r["n_known"] == sum(counts[x] > 0 for x in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (kinds + 1))) for x in own))
        assert r["score"] == pytest.approx(brute_ppm([(x or "").encode() for x in train], (t or "").encode()), abs=1e-6)


@pytest.mark.parametrize("order", [2, 3, 5, 7])
def test_scores_of_other_orders_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(ppm, "PACKS_PER_GROUP", 2)  # several copies of each bucket
    rng = random.Random(order)
    words = ["the", "then", "Sat", "on", "mat", "é", "zebra!", "\t"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for i in range(30)] + [(30, None), (31, "qqq \x00")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    train = [(t or "").encode() for d, t in rows if d % 4]
    got = {r["doc_id"]: r["score"] for r in ppm.scores(docs, F.col("doc_id") % 4 == 0, pack=100, order=order).collect()}
    assert got == {d: pytest.approx(brute_ppm(train, (t or "").encode(), order), abs=1e-6) for d, t in rows}
    with pytest.raises(ValueError, match="order"):
        ppm.scores(docs, F.lit(True), order=8)


def test_probabilities_of_a_context_sum_to_one():
    text = b"abracadabra alakazam"
    data = np.frombuffer(bytes([ppm.PAD] * 3) + text + bytes([ppm.END]), np.uint8).astype(np.uint32)
    trained = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    first = np.zeros((256, 256), np.int64)
    np.add.at(first, ((trained >> 8) & 255, trained & 255), 1)
    symbols = np.array([s for s in range(256) if s != ppm.PAD], np.uint32)
    for context in (b"abr", b"xbr", b"xxr", b"xxx"):
        asked = (context[0] << 24 | context[1] << 16 | context[2] << 8) + symbols
        codes, counts = ppm._summed([trained, asked.astype(np.uint32)], [np.ones(len(trained), np.int64), np.zeros(len(asked), np.int64)])
        values = ppm.log_probabilities(codes, counts, first, 3)
        assert (10 ** values[np.searchsorted(codes, asked)]).sum() == pytest.approx(1)


def test_scores_without_training_rows_and_of_nothing(spark):
    docs = spark.createDataFrame([(1, "ab c")], "doc_id long, text string")
    row = ppm.scores(docs, F.lit(True)).first()
    assert (row["n_known"], row["train_tokens"]) == (0, 0) and row["score"] == pytest.approx(-5 * math.log10(255))
    assert ppm.scores(docs.limit(0), F.lit(True)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    names = source.columns
    extra = source.withColumn("size", F.lit("s")).withColumn("path", F.lit(1))
    odd = spark.createDataFrame([(None, None, None, None, None, "s", 1), (-1, "", "en", "a", 0, "s", 1)], extra.schema)
    docs = extra.unionByName(odd).unionByName(extra.limit(5))
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        assert stage(spark, docs.limit(0), sf).count() == 0
        docs = spark.read.parquet(path)
        if name != "mixing":
            assert docs.columns == [*names, "size", "path"]
    assert {"epoch", "words"} <= set(docs.columns) and docs.count() > 50
    assert corpus_pipeline.run(spark, sf).count() > 50
