"""Rows sorted by a key in whole groups, as columns that a task computes on at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 1 << 17


def blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of some ROWS rows, more where a group of equal keys is larger; rows come sorted by keys and groups stay whole."""
    held, n, enough = [], 0, ROWS
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(n - 1, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            new |= c[1:] != c[:-1]
        last = np.flatnonzero(new)[-1:] + 1
        if last.size:
            yield table.slice(0, int(last[0]))
            table = table.slice(int(last[0]))
        held, n = table.to_batches(), table.num_rows
        enough = max(ROWS, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def by_blocks(df: DataFrame, keys: list[str], order: list[str], f: Callable[..., Iterator[dict]], schema: str) -> DataFrame:
    """The rows that f makes of each block; a group of equal keys comes whole and sorted by keys and order."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, keys):
            for out in f(*(table.column(n).to_numpy() for n in names)):
                yield from pa.table(out).to_batches(max_chunksize=1 << 16)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where a row begins a group of equal sorted keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


# --- rasters in tiles ---------------------------------------------------------------------------------------------------

TILE = 256


class Tiles:
    """Cells of a block of tiles as sorted codes, next to which those of the neighbours are found by adding steps."""

    def __init__(self, halo: int, tx: np.ndarray, ty: np.ndarray, cx: np.ndarray, cy: np.ndarray):
        self.halo, self.side, new = halo, TILE + 2 * halo + 2, starts(tx, ty)
        self.tx, self.ty = tx[new], ty[new]
        local = lambda c, t: c - t * TILE + halo + 1
        self.codes = ((np.cumsum(new) - 1) * self.side + local(cx, tx)) * self.side + local(cy, ty)
        self.end = len(self.tx) * self.side**2

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(lx, ly, cx, cy) of codes."""
        rest, ly = np.divmod(codes, self.side)
        tile, lx = np.divmod(rest, self.side)
        return lx, ly, self.tx[tile] * TILE + lx - self.halo - 1, self.ty[tile] * TILE + ly - self.halo - 1

    def within(self, lx: np.ndarray, ly: np.ndarray, margin: int) -> np.ndarray:
        return (lx > margin) & (lx <= self.side - 2 - margin) & (ly > margin) & (ly <= self.side - 2 - margin)


def in_tiles(cells: DataFrame, halo: int, f: Callable[..., Iterator[dict]], schema: str) -> DataFrame:
    """The rows that f makes of each block of tiles; each tile has the cells at most halo around it too."""
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / TILE), F.floor((F.col(c) + halo) / TILE)))
    rest = [c for c in cells.columns if c not in ("cx", "cy")]
    rows = cells.withColumn("tx", span("cx")).withColumn("ty", span("cy")).select("tx", "ty", "cx", "cy", *rest)
    return by_blocks(rows, ["tx", "ty"], [], f, schema)
