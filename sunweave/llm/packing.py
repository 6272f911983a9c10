"""Operator 4: packing tokenised documents into sequences of fixed capacity, by exact complements and best fit.

Only documents longer than a sequence are cut. The plan is made from the histogram of piece lengths, which has at most as
many entries as the capacity whatever the input: for the longest pieces left, the gap is looked up in an index of single,
pair and triple sums of the lengths still available, combinations that fill it exactly are consumed as often as the
counts allow, and what no combination fills gets the best fit, again and again. The plan's slots are then dealt to the
pieces by their rank within their length; ranks are counted in salted parts, so that a length that very many pieces have
is never ordered in one task.

Defined results: a null text is an empty one, its end id only; a null id stays null; repeated rows and rows with equal
ids are packed each; texts of any length are encoded whole and cut by ids alone; ill-formed UTF-8 is mended first; pieces
of equal length are alike to the plan, so that ties only decide which of them takes which place, by hash and then id; an
empty table gives an empty table; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunweave.llm.arrow import settle, slices, strings
from sunweave.llm.tokens import default_path, word_encoder
from sunweave.sources.shared import written

CAPACITY = 4096
BATCH_BYTES = 4 << 20
PART_ROWS = 50_000


def cut_pieces(docs: DataFrame, model: str, end_id: int = 1, capacity: int = CAPACITY, kind: str | None = None, with_ids: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): each document's ids and its end id, in pieces of the capacity."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    type_ = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        encoder = word_encoder(model if os.path.isabs(model) else default_path(model), kind)
        for part in slices(batches, "text", BATCH_BYTES):
            flat, bounds = encoder.encode_column(strings(part.column("text")), end_id)
            pieces = -(-np.diff(bounds) // capacity)
            index = np.repeat(np.arange(len(pieces)), pieces)
            piece = np.arange(len(index)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = bounds[index] + piece * capacity
            stop = np.minimum(first + capacity, bounds[index + 1])
            data = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
            spans = [data[4 * a : 4 * b] for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
            columns = {key: part.column("key").take(pa.array(index)), "piece": pa.array(piece, pa.int32()), "start": pa.array(piece * capacity, pa.int64()), "length": pa.array(stop - first), "ids_crc32": pa.array(map(zlib.crc32, spans), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(map(bytes, spans), pa.binary())} if with_ids else {}))

    return rows.mapInArrow(run, f"`{key}` {type_}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class SumIndex:
    """Which sums one, two or three available lengths can make."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.renew()

    def renew(self) -> None:
        self.one = self.left > 0
        n = len(self.left)
        had = self.one.astype(np.float64)
        self.two = np.fft.irfft(np.fft.rfft(had, 2 * n) ** 2, 2 * n)[:n] > 0.5
        self.three = np.fft.irfft(np.fft.rfft(had, 2 * n) * np.fft.rfft(self.two.astype(np.float64), 2 * n), 2 * n)[:n] > 0.5

    def single(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] > used[gap] else None

    def pair(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """The pair with the longest piece that is still available."""
        if gap < 2 or not self.two[gap]:
            return None
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in longer[(self.left[longer] > 0) & (self.left[gap - longer] > 0)].tolist():
            need = Counter((a, gap - a)) + used
            if all(self.left[x] >= need[x] for x in (a, gap - a)):
                return (a, gap - a)
        return None

    def triple(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        if gap < 3 or not self.three[gap]:
            return None
        longest = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        for a in longest[(self.left[longest] > 0) & self.two[gap - longest]].tolist():
            if self.left[a] > used[a] and (rest := self.pair(gap - a, used + Counter((a,)))):
                return (a, *rest)
        return None

    def exact(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        return self.single(gap, used) or self.pair(gap, used) or self.triple(gap, used)


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), using each piece of the histogram once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    index, plan, alive = SumIndex(left), [], int((left > 0).sum())
    for longest in range(capacity, 0, -1):
        while left[longest] > 0:
            shape, gap = [longest], capacity - longest
            while gap > 0:
                used = Counter(shape)
                if fill := index.exact(gap, used):
                    shape += fill
                    break
                fits = np.flatnonzero(left[1 : gap + 1] > 0)[::-1] + 1
                best = next((x for x in fits.tolist() if left[x] > used[x]), None)
                if best is None:
                    break
                shape.append(best)
                gap -= best
            need = Counter(shape)
            times = min(int(left[x]) // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= k * times
            plan.append((tuple(shape), times))
            if (now := int((left > 0).sum())) < alive:
                alive = now
                index.renew()
    return plan


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each slot, its first sequence and its offset."""
    taken: Counter = Counter()
    slots: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for shape, times in plan:
        offset = 0
        for length in shape:
            slots.setdefault(length, []).append((taken[length], base, offset))
            taken[length] += times
            offset += length
        base += times
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in slots.items()}


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with key, piece, start, length and ids_crc32, the key first.

    Null keys are placed like others; a piece longer than the capacity, or without length, raises.
    """
    names = pieces.columns
    key = names[0]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    if any(not n or not 0 < n <= capacity for n in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(make_plan(counts, capacity)))
    total = sum(counts.values())
    salt = F.pmod(F.xxhash64(key, "piece", "start", "ids_crc32"), F.lit(max(1, -(-total // PART_ROWS)))).cast("int")
    rows = pieces.withColumn("_salt", salt)
    parts = rows.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_salt").orderBy(key, "piece", "ids_crc32")
    rows = rows.withColumn("_own", F.row_number().over(own) - 1).join(parts, ["length", "_salt"])
    rows = rows.select(*names, (F.col("_base") + F.col("_own")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                first, base, at = slots.value[length]
                slot = np.searchsorted(first, ranks[own], "right") - 1
                sequence[own], offset[own] = base[slot] + ranks[own] - first[slot], at[slot]
            columns = {c: batch.column(c) for c in names}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return rows.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, model: str, end_id: int = 1, capacity: int = CAPACITY, kind: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return place(written(cut_pieces(docs, model, end_id, capacity, kind, text=text, key=key), "pieces"), capacity)
