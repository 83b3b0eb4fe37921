"""Merkle manifests against a tree built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemart.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def build(nodes, arity):
    """Levels of digests from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i:i + arity]) for i in range(0, len(below), arity)])
    return levels


def walk(levels, at, start, arity):
    """Siblings on the way up, and the top that `start` leads to."""
    proof, now = "", start
    for level in levels[:-1]:
        low = at - at % arity
        left, right = "".join(level[low:at]), "".join(level[at + 1:low + arity])
        proof, now, at = proof + left + right, digest(left, now, right), at // arity
    return proof, now


def brute(rows, arity):
    def leaf(row, text):
        return digest(*(encoded(v) for v in (row[0], row[1], row[2], row[3], text)))

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    inner = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r, r[4]))))
        inner[name] = build([leaf(r, r[4]) for r in trees[name]], arity)
    last = build([inner[n][-1][0] for n in names], arity)
    out = []
    for at_name, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            first, now = walk(inner[name], at, leaf(row, text), arity)
            second, now = walk(last, at_name, now, arity)
            root = last[-1][0]
            out.append((row[0], leaf(row, row[4]), inner[name][-1][0], root, digest(first + second), now, now == root))
    return sorted(out, key=str)


def corpus():
    langs = ["en"] * 140 + ["de"] * 17 + ["fr"] * 8 + [None] * 9 + ["é"] * 1 + ["Z"] * 64 + [f"l{i}" for i in range(12)]
    rows = [(i * 7 % 911, f"s{i % 4}" if i % 5 else None, lang, i if i % 3 else None, f"Text {i} ÄB" if i % 11 else None) for i, lang in enumerate(langs)]
    return rows + [(5, "s", "en", 1, "Same")] * 3 + [(5, "s", "en", 1, "Other"), (None, None, "en", None, None), (6, "", "", 0, "")]


@pytest.mark.parametrize("arity", [8, 2, 3])
def test_manifest_equals_a_tree_built_by_hand(spark, arity):
    rows = corpus()
    docs = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, at int, tree string"
    ).repartition(4)
    got = merkle.manifest(docs, changed={"text": merkle.lowered_third()}, arity=arity)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == brute(rows, arity)
    assert {r[6] for r in found} == {True, False}


def test_one_row_and_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    row = merkle.manifest(spark.createDataFrame([(1, "a", None, 2, "")], schema)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == digest("1:1", "1:a", "-", "1:2", "0:")
    assert row["proof_sha256"] == digest("") and row["verified"]


def test_any_other_change_is_found(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame([(i, "a", "en", 1, "text") for i in range(20)], schema)
    got = merkle.manifest(docs, changed={"source": F.when(F.col("doc_id") == 7, "b").otherwise(F.col("source"))})
    assert [r["doc_id"] for r in got.where("NOT verified").collect()] == [7]
    assert merkle.manifest(docs).where("NOT verified").isEmpty()
