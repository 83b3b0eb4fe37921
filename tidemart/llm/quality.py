"""Quality rules as a ledger: every rule is evaluated once, its failure is one bit, its measurements are kept.

Policies are masks over the bits. Changing a policy, comparing two, or asking what a rule alone removes never
reads a text again.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.text import LONG, free_name, in_small_batches, pick, struct

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_bangs",
)
_SPACE = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = re.compile("[A-Z]+")


def measure(text: str | None) -> tuple[int, ...]:
    """The values of `MEASURES` for one whole text; NULL counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeated += start + 3 - max(start, covered)
                covered = start + 3
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACE)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        sum(map(len, _CAPITALS.findall(text))),
        text.count("!"),
    )


@F.pandas_udf(struct(**dict.fromkeys(MEASURES, LONG)))
def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


#: Rule by bit number: name and the condition, over the measurements, under which a document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("capitals", "100 * n_capitals > 30 * word_chars"),
    ("bangs", "100 * n_bangs > 20 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)

#: Policy versions: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in rules)


def _bits(measured: str) -> Column:
    """The failure bits, from a struct column of measurements."""
    total = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        for name in MEASURES:
            condition = re.sub(rf"\b{name}\b", f"`{measured}`.{name}", condition)
        total = total + F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return total


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, all measurements and `failed_bits`.

    NULL or empty texts have no words and fail `few_words`. Repeated rows are measured each for itself; columns
    other than the two named are not read. An empty table gives an empty ledger.
    """
    measured = in_small_batches(pick(docs, id_col, text_col)).select(
        F.col(f"`{id_col}`").alias("doc_id"), _measures(F.col(f"`{text_col}`")).alias("m")
    )
    return measured.select("doc_id", *(F.col(f"m.{n}") for n in MEASURES), _bits("m").alias("failed_bits"))


def passes(policy: str, bits: str = "failed_bits") -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col(f"`{bits}`").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def keep(docs: DataFrame, policy: str, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass a policy version, with the columns of `docs`.

    NULL and empty texts fail. Column names of `docs` may clash with the measurements.
    """
    name = free_name(docs, "measured")
    measured = in_small_batches(docs).withColumn(name, _measures(F.col(f"`{text_col}`")))
    accepted = _bits(name).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0
    return measured.where(accepted).drop(name)


def ablations(rows: DataFrame) -> DataFrame:
    """What each rule does under each policy, from the failure bits of a ledger alone.

    `policy`, `rule`, `n_rejected` by the policy, `n_failed` of the rule, `n_only` rejected by no other rule of the
    policy (what dropping the rule would bring back). The ledger is first reduced to one row per distinct bit
    pattern, at most two to the number of rules.
    """
    patterns = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    pairs = [
        F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"),
            F.lit(mask(rules)).cast("long").alias("mask"), F.lit(mask((rule,))).cast("long").alias("bit"),
        )
        for policy, rules in POLICIES.items()
        for rule in rules
    ]
    hit = F.col("failed_bits").bitwiseAND(F.col("p.mask"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return (
        patterns.withColumn("p", F.explode(F.array(*pairs)))
        .groupBy("p.policy", "p.rule")
        .agg(
            count(hit != 0)("n_rejected"),
            count(F.col("failed_bits").bitwiseAND(F.col("p.bit")) != 0)("n_failed"),
            count(hit == F.col("p.bit"))("n_only"),
        )
    )
