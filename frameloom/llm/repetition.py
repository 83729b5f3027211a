"""Repetition inside a text, as a ledger of rules.

Method: every rule is evaluated once per text; the ledger keeps the measured
values and one bit per failed rule. Policies are versioned masks over these
bits and are applied later without touching the text; what each rule alone
decides (the ablation) follows from the counts of the bit patterns.

Defined results: a null, empty or wordless text has no words, all its shares
are 0 and no bit is set. Whole texts are measured, whatever their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.!?。！？]+|[\r\n]+")
LINE = re.compile(r"[\r\n]+")
RUN = 5

#: Bit numbers of the rules; a bit never changes its meaning. Each rule: measurement, limit, and whether it fails at or above it.
RULES = (("run_share", 0.3, True), ("sentence_share", 0.3, True), ("line_share", 0.3, True), ("top_pair_share", 0.2, True), ("distinct_share", 0.3, False))


@dataclass(frozen=True)
class Policy:
    """A text is a case if any (or all) of the masked rules fail."""

    version: str
    mask: int
    every: bool = False

    def decide(self, bits: Column) -> Column:
        hit = bits.bitwiseAND(F.lit(self.mask))
        return (hit == self.mask) if self.every else (hit != 0)


POLICIES = (Policy("v1", 0b00001), Policy("v2", 0b00111), Policy("v3", 0b11111), Policy("v4-strict", 0b00011, every=True))


def repeated_words(words: Sequence[str], run: int = RUN) -> int:
    """Number of words in a run of ``run`` words that also begins at an earlier word."""
    n = len(words)
    seen: set = set()
    count = covered = 0
    for i in range(n - run + 1):
        g = tuple(words[i : i + run])
        if g in seen:
            count += i + run - max(covered, i)
            covered = i + run
        else:
            seen.add(g)
    return count


def _parts_share(parts: list[str], n: int) -> float:
    """Share of the words that stand in a part (sentence, line) whose words stood in an earlier part."""
    seen: set = set()
    again = 0
    for p in parts:
        w = tuple(WORD.findall(p))
        if w:
            if w in seen:
                again += len(w)
            else:
                seen.add(w)
    return again / n if n else 0.0


def measure(text: str | None) -> tuple:
    """n_words, n_repeated, the measurements of RULES in order, fail_bits."""
    t = (text or "").upper().lower()
    w = WORD.findall(t)
    n = len(w)
    if not n:
        return (0, 0, 0.0, 0.0, 0.0, 0.0, 1.0, 0)
    rep = repeated_words(w)
    pairs = Counter(zip(w, w[1:]))
    top = max(pairs.values()) if pairs else 0
    vals = (
        rep / n, _parts_share(SENTENCE.split(t), n), _parts_share(LINE.split(t), n),
        top / (n - 1) if top > 1 else 0.0, len(set(w)) / n,
    )
    bits = 0
    for k, ((_, limit, above), v) in enumerate(zip(RULES, vals)):
        if (v >= limit) if above else (v <= limit):
            bits |= 1 << k
    return (n, rep, *vals, bits)


LEDGER = "table_name string, row_key bigint, n_words bigint, n_repeated bigint, run_share double, sentence_share double, line_share double, top_pair_share double, distinct_share double, fail_bits bigint"


def ledger(texts: DataFrame) -> DataFrame:
    """The ledger of (table_name, row_key, text); one Arrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in b.column(2).to_pylist()]
            cols = list(zip(*rows)) if rows else [[] for _ in range(8)]
            types = [pa.int64(), pa.int64(), *[pa.float64()] * 5, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=["table_name", "row_key", "n_words", "n_repeated", *[r[0] for r in RULES], "fail_bits"],
            )

    return texts.select("table_name", "row_key", "text").mapInArrow(run, LEDGER)


def cases(book: DataFrame, policy: Policy) -> DataFrame:
    return book.where(policy.decide(F.col("fail_bits")))


def ablation(book: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """Per policy and rule: texts decided, texts that fail the rule, and texts no longer decided without it.

    The ledger is folded to counts per bit pattern first (at most two to the
    number of rules), so a new policy costs nothing of the corpus.
    """
    patterns = book.groupBy("table_name", "fail_bits").agg(F.count(F.lit(1)).alias("n"))
    out = None
    for p in policies:
        for k, (rule, _, _) in enumerate(RULES):
            bit = 1 << k
            if not p.mask & bit:
                continue
            less = Policy(p.version, p.mask & ~bit, p.every)
            now = p.decide(F.col("fail_bits"))
            then = less.decide(F.col("fail_bits")) if less.mask else F.lit(False)
            one = patterns.groupBy("table_name").agg(
                F.lit(p.version).alias("policy"), F.lit(rule).alias("rule"),
                F.sum(F.when(now, F.col("n")).otherwise(0)).alias("n_cases"),
                F.sum(F.when(F.col("fail_bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
                F.sum(F.when(then, F.col("n")).otherwise(0)).alias("n_without"),
            )
            out = one if out is None else out.unionByName(one)
    return out
