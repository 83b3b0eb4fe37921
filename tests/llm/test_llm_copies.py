"""Substring removal by FM-indexes against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidemart.llm import copies, fm

WIDTH = copies.WIDTH


def brute(rows):
    """Every window against every window."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for a in range(len(words) - WIDTH + 1):
                key = tuple(words[a:a + WIDTH])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for a in range(len(words) - WIDTH + 1):
            if i is not None and first[tuple(words[a:a + WIDTH])] < i:
                gone.update(range(a, a + WIDTH))
        kept = b" ".join(w for a, w in enumerate(words) if a not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def corpus(count=120):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice((9, 13, 14, 30, 90)))] for _ in range(12)]
    rows = []
    for i in range(count):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((rng.randrange(count), rng.choice((" ", "\n", "\t \x0b")).join(words)))
    hot = ["same"] * 5 + ["passage", "in", "all"]
    for i in range(count, count + 90):  # one short string in ever other company, so that its hash has many segments
        rows.append((i, " ".join([*(rng.choice(vocabulary) for _ in range(12)), *hot, *(rng.choice(vocabulary) for _ in range(12))])))
    rows += [(i, " ".join(["z"] * n)) for i, n in ((900, 400), (901, 200), (902, 12), (903, 13))]
    rows += [(910, rows[3][1]), (910, rows[3][1]), (None, rows[3][1]), (None, None), (911, None), (912, ""), (913, " \n "), (914, "é\xa0ü " * 20)]
    rows += [(915, "é\xa0ü " * 14), (-5, rows[4][1] + " a b c"), (916, "x" * 5000 + " " + "y" * 5000)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"pack": 3000, "herd": 2, "crowd": 3, "shards": 5}, {"pack": 3000, "shards": 3}])
def test_substring_dedup_equals_brute_force(spark, settings):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, anchor string, pack int").repartition(3)
    got = copies.without_copies(docs, **settings)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"]
    found = got.collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in found), key=str) == brute(rows)
    assert all(sum(s["high"] - s["low"] for s in r["spans"]) == r["n_removed"] for r in found)
    assert any(r["n_removed"] for r in found)


def test_substring_dedup_of_nothing(spark):
    assert copies.without_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_are_split_into_the_same_words(monkeypatch):
    text = (" ".join(f"word{i}" for i in range(3000)) + "\n" + "q" * 900 + "\t\x0c end").encode()
    whole = copies.word_hashes(text)
    monkeypatch.setattr(copies, "PIECE", 100)
    assert np.array_equal(copies.word_hashes(text), whole) and len(whole) == 3002
    assert b"".join(copies.pieces(text)) == text


def strings(rng, count, alphabet):
    return [rng.integers(0, alphabet, rng.integers(1, 60)).astype(np.uint64) * np.uint64(977) for _ in range(count)]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_index_finds_smallest_owner_of_each_window(alphabet):
    rng = np.random.default_rng(alphabet)
    held, asked = strings(rng, 70, alphabet), strings(rng, 40, alphabet + 1)
    owner = rng.integers(0, 30, 70)
    width = 5
    index = fm.FMIndex(np.concatenate(held), np.array([len(s) for s in held]), owner, width)
    least = {}
    for s, o in zip(held, owner):
        for a in range(len(s) - width + 1):
            least[tuple(s[a:a + width])] = min(least.get(tuple(s[a:a + width]), fm.NOBODY), int(o))
    for texts in (held, asked):
        expected = [least.get(tuple(s[a:a + width]), fm.NOBODY) for s in texts for a in range(len(s) - width + 1)]
        got = index.owners(np.concatenate(texts), np.array([len(s) for s in texts]))
        assert got.tolist() == expected


def test_bits_and_wavelet_matrix_count():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 37, 1000)
    matrix = fm.WaveletMatrix(symbols, 37)
    at, symbol = rng.integers(0, 1001, 400), rng.integers(0, 38, 400)
    assert matrix.rank(symbol, at).tolist() == [int((symbols[:a] == s).sum()) for a, s in zip(at, symbol)]
    bits = rng.random(640) < 0.3
    assert fm.Bits(bits).rank(np.arange(641)).tolist() == [int(bits[:i].sum()) for i in range(641)]


def test_suffix_order():
    rng = np.random.default_rng(6)
    text = np.concatenate([[*(rng.integers(0, 3, 30) + 40), i] for i in range(40)])
    assert fm.suffixes(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
