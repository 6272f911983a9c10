"""Documents in blocks, and hashes dealt out by ranges: what the operators on shingles and passages share.

A block is some megabytes of documents, as a compressed Arrow stream of pages in a file of the shared folder; a page, of whole
documents, is what is decoded at once. Tasks are told the files, so that texts are never shuffled; a table names those that
counted, so that a task that runs again leaves at most a file that nobody reads, until all go. To find out what several blocks have in common, each sends its sorted hashes,
cut by ranges, as compressed differences (some three bytes a hash), and each range answers the blocks with what it found.
Blocks and ranges grow with the square root of the input, so that the messages between all of them grow in proportion to
it, up to what fits the memory of a worker (BLOCK_MOST, RANGE_MOST); from there on, at some hundreds of gigabytes with the
values here, they grow with its square unless both are raised with the memory. Equal hashes of one block are one entry, so
that frequent ones don't make a range large.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunweave.llm.arrow import each_row, slices, utf8
from sunweave.sources.shared import held_by, new_path, written

#: Bytes of text in a page, and in the blocks of up to a gigabyte; in the ranges of those.
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 24 << 20
BLOCK_MOST = 64 << 20
RANGE_MOST = 64 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _grown(base: int, most: int, total: int) -> int:
    """Bytes of a block or range for so many in all."""
    return min(max(base, most), int(base * math.sqrt(max(1.0, total / (1 << 30)))))


def make_blocks(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """(block, n_bytes, file): all rows with the named columns; within a block they are sorted by the first of them."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    size, page = _grown(BLOCK_BYTES, BLOCK_MOST, total), BLOCK_BYTES
    path = new_path(docs.sparkSession, "pages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, parts, total = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).sort_by([(columns[0], "ascending")]).combine_chunks()
            file = f"{path}/{task}-{count}-{uuid.uuid4().hex[:8]}.arrow"
            fs, base = pafs.FileSystem.from_uri(file)
            fs.create_dir(base.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(base) as sink, pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in slices(iter(table.to_batches()), text, page):
                    out.write_batch(part)
            return pa.RecordBatch.from_pydict({"block": [f"{task}-{count}"], "n_bytes": [total], "file": [file]})

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                base = sizes[start - 1] if start else 0
                stop = min(max(start + 1, int(np.searchsorted(sizes, base + size - total, "right"))), batch.num_rows)
                parts.append(batch.slice(start, stop - start))
                total += int(sizes[stop - 1] - base)
                start = stop
                if total >= size or start < batch.num_rows:
                    yield row()
                    count, parts, total = count + 1, [], 0
        if parts:
            yield row()

    table = written(docs.select(*columns).mapInArrow(run, "block string, n_bytes long, file string"), "blocks")
    held_by(table, path)
    return table


def pages(file: str) -> Iterator[pa.Table]:
    """The pages of a block, one at a time; each has whole documents, and their order is that of the block."""
    fs, base = pafs.FileSystem.from_uri(file)
    with fs.open_input_file(base) as source:
        for batch in pa.ipc.open_stream(source):
            yield pa.Table.from_batches([batch])


def tasks(blocks: DataFrame) -> int:
    """Into how many tasks work on blocks goes: one for each, as far as Spark can plan that."""
    return max(1, min(blocks.count(), 100_000))


def dimensions(blocks: DataFrame) -> tuple[int, int]:
    """(number of ranges, bits of a hash that are sent): chance hits stay rarer than one in some thousands."""
    total = blocks.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    return max(1, -(-total // _grown(RANGE_BYTES, RANGE_MOST, total))), min(58, max(32, int(total // 6 + 1).bit_length() + 13))


# --- hashes -----------------------------------------------------------------------------------------------------------


def block_words(table: pa.Table, text: str = "text", lower: bool = False) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each document, their hashes in one array, and where each document starts in it (and the end)."""
    texts = utf8(table.column(text).combine_chunks())
    words = [(x.lower() if lower else x).split() for x in texts]
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    flat = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(starts[-1]))
    return words, flat, starts


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive elements; the last n - 1 places have none and are left out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, width, power = None, 0, hashes
        size, factor = 1, _ODD
        while True:  # by doubling: power has hashes of size elements, out those of the width already taken
            if n & size:
                out = power.copy() if out is None else out[: len(out) - size] * factor + power[width : width + len(out) - size]
                width += size
            if width == n:
                break
            power = power[:-size] * factor + power[size:]
            size, factor = size * 2, factor * factor
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def places(starts: np.ndarray, n: int) -> np.ndarray:
    """Where windows of n words start that lie within one document, in ascending order."""
    total = int(starts[-1])
    if total < n:
        return np.zeros(0, np.int64)
    good = np.ones(total - n + 1, bool)
    ends = np.unique(starts[1:-1])
    for back in range(1, n):
        at = ends - back
        good[at[(at >= 0) & (at < len(good))]] = False
    return np.flatnonzero(good)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several sorted arrays, and the sum of their counts."""
    every = np.concatenate([*keys, np.zeros(0, np.uint64)])
    number = np.concatenate([*counts, np.zeros(0, np.int64)])
    if len(keys) < 2 or not len(every):
        return every, number
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    lead = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[lead], np.add.reduceat(number, lead)


# --- compressed columns -------------------------------------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """A column of numbers, by bytes of equal weight."""
    flat = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T.tobytes())


def unsqueeze(data: bytes, dtype=np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data), dtype=np.uint64)


def cuts(tops: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where sorted hashes of some bits fall into the next range: ranges + 1 places."""
    bounds = np.array([-(-(i << bits) // ranges) for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(tops, bounds), [len(tops)]]).astype(np.int64)


# --- exchange -----------------------------------------------------------------------------------------------------------

Sent = list[tuple[int, bytes]]


def ask(blocks: DataFrame, send: Callable[[Iterator[pa.Table]], Sent], answer: Callable[[list[bytes]], list[bytes | None]], replied: DataFrame | None = None) -> DataFrame:
    """(block, file, replies): every block with what the ranges answered it, in a task for each block.

    send gets a block's pages (and, where replied has them, its earlier replies) and returns (range, bytes); answer gets the
    bytes of all blocks for one range and returns an answer for each of them or None.
    """
    n, told = tasks(blocks), replied is not None

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            sent = send(pages(row["file"]), *([row["replies"]] if told else []))
            yield pa.RecordBatch.from_pydict({"range": pa.array([k for k, _ in sent], pa.int32()), "block": pa.array([row["block"]] * len(sent), pa.string()), "sent": pa.array([x for _, x in sent], pa.binary())})

    def answers(table: pa.Table) -> pa.Table:
        out = answer(table.column("sent").to_pylist())
        keep = [(b, x) for b, x in zip(table.column("block").to_pylist(), out, strict=True) if x is not None]
        return pa.table({"block": pa.array([b for b, _ in keep], pa.string()), "reply": pa.array([x for _, x in keep], pa.binary())})

    source = replied if told else blocks.select("block", "file").repartition(n)
    found = source.mapInArrow(ranges, "range int, block string, sent binary").groupBy("range").applyInArrow(answers, "block string, reply binary")
    every = found.withColumn("file", F.lit(None).cast("string")).unionByName(blocks.select("block", "file", F.lit(None).cast("binary").alias("reply")))
    return every.repartition(n, "block").groupBy("block").agg(F.max("file").alias("file"), F.collect_list("reply").alias("replies"))
