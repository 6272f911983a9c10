"""Operator 10: a ledger of quality rules as bit masks.

Every rule is evaluated once on every document; the ledger keeps the measurements and one bit for each rule that fails.
A policy is a named, versioned mask of the rules that reject; applying it, or leaving single rules out of it to see what
each of them rejects alone, is bit arithmetic over the ledger and doesn't touch the texts again.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: a null or empty text has no words and fails the base rules; a null
id stays null; repeated rows each get a row; texts of any length are measured whole, in batches of bounded bytes;
ill-formed UTF-8 is mended first; an empty table gives an empty table, and no rules in an ablation; further columns are left
out unless ``attach`` is asked for, which keeps all of them in a struct, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunweave.llm.arrow import settle, slices, utf8

BATCH_BYTES = 4 << 20
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A document fails where the SQL condition over the measurements holds; all are integer arithmetic."""

    name: str
    fails: str


#: In bit order; a rule once published keeps its bit.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, r in enumerate(RULES) if r.name in self.rules)


BASE = Policy("base", 1, ("too_few_words", "repeated_words"))
PROSE = Policy("prose", 1, tuple(r.name for r in RULES))


def measure(data: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = data.split()
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    word_chars = sum(len(w) for w in words)
    if not data.isascii():
        word_chars = len(b"".join(words).decode())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = set(windows)
    if len(seen) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        end = 0
        for i, w in enumerate(windows):
            if w in often:
                repeats += i + 3 - max(i, end)
                end = i + 3
    return n, word_chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines)


def _mask() -> Column:
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("long")


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id", attach: bool = False) -> DataFrame:
    """(key, measurements, failed): failed has bit i set where RULES[i] fails. attach: a struct ``row`` of all columns."""
    own = F.struct(*[docs[c] for c in docs.columns]).alias("row") if attach else F.col(text).alias("text")
    rows = docs.select(F.col(key).alias("key"), own)
    kept = [f for f in rows.schema if f.name != "text"]
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + "".join(f", {m} long" for m in MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        of = (lambda b: b.column("row").field(at)) if attach else (lambda b: b.column("text"))
        for part in slices(batches, of, BATCH_BYTES):
            found = list(zip(*map(measure, utf8(of(part))), strict=True))
            yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [pa.array(x, pa.int64()) for x in found], names=[*(f.name for f in kept), *MEASURES])

    out = rows.mapInArrow(run, schema).withColumn("failed", _mask())
    return out if key == "key" else out.withColumnRenamed("key", key)


def rejected(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) != 0


def ablation(book: DataFrame, policy: Policy, failed: str = "failed") -> DataFrame:
    """(rule, n_failed, n_only): documents that fail each rule of the policy, and those that no other rule rejects.

    One aggregation over the distinct masks, of which there are at most two to the number of rules.
    """
    masks = book.select(F.col(failed).bitwiseAND(F.lit(policy.mask)).alias("m")).groupBy("m").agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if r.name in policy.rules]
    each = masks.select("m", "n", F.inline(F.array(*rules)))
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("m").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
