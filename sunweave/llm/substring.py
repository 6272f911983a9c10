"""Operator 6: removal of passages that occur earlier, found by fixed-block anchors.

Non-overlapping anchors of 10 words are indexed in every document and probed by every rolling window of 10 words of all
documents. A window of 20 words holds a whole anchor of its own document, and if it occurs elsewhere, that anchor is hit
there; only windows whose anchor is hit elsewhere go on. Their hits are extended to the exact 20-word windows, of which
the first occurrence by (document, start) is found, and the union of the others' words, the maximal repeats that begin
earlier, is removed.

Anchors travel as truncated hashes, whose chance hits only cost work; windows are told apart by 64-bit hashes of all 20
words. Blocks send one entry for each window sequence, so that a passage that everybody shares doesn't meet in one task;
a range tells a block which of its sequences begin earlier elsewhere, and of those that begin first in the block, but come
there again, where they begin.

Defined results: ids are integers; a null or empty text has no words; a text shorter than the window loses nothing; texts
of any length are taken whole; rows with equal ids are one document to each other: only an earlier start counts between
them; a null id comes last; ill-formed UTF-8 is mended first; an empty table gives an empty table; further columns are left
out or, for texts, kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sunweave.llm import blocks as B
from sunweave.llm.arrow import each_row, strings

WINDOW = 20
_LAST = np.iinfo(np.int64).max


def _anchor_width(window: int) -> int:
    """The largest width of which any window holds a whole aligned anchor."""
    return max(1, window // 2)


def _send_anchors(window: int, ranges: int, bits: int):
    width = _anchor_width(window)

    def send(pages: Iterator[pa.Table]) -> B.Sent:
        keys, counts = [], []
        for table in pages:
            _, words, starts = B.block_words(table)
            at = B.places(starts, width)
            if len(at):
                tops = B.rolling(words, width)[at] >> np.uint64(64 - bits)
                doc = np.searchsorted(starts, at, "right") - 1
                aligned = ((at - starts[doc]) % width == 0).astype(np.uint64)
                key, n = np.unique((tops << np.uint64(1)) | aligned, return_counts=True)
                keys.append(key), counts.append(n)
        both, n = B.merged(keys, counts)
        if not len(both):
            return []
        tops, index = np.unique(both >> np.uint64(1), return_index=True)
        last = np.append(index[1:], len(both)) - 1
        anchor = both[last] & np.uint64(1)  # aligned ones stand last
        often = (np.add.reduceat(n, index) > 1).astype(np.uint64)
        coded = (tops << np.uint64(2)) | (anchor << np.uint64(1)) | often
        cut = B.cuts(tops, bits, ranges)
        return [(i, B.squeeze_sorted(coded[a:b])) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]

    return send


def _answer_anchors(sent: list[bytes]) -> list[bytes | None]:
    """Hashes of anchors that occur at least twice, to each block that has them."""
    each = [B.unsqueeze_sorted(x) for x in sent]
    every = np.sort(np.concatenate(each))
    tops, index, n = np.unique(every >> np.uint64(2), return_index=True, return_counts=True)
    anchor = np.maximum.reduceat(every & np.uint64(2), index) > 0
    often = (n > 1) | (np.maximum.reduceat(every & np.uint64(1), index) > 0)
    hits = tops[anchor & often]
    out = []
    for x in each:
        mine = x >> np.uint64(2)
        mine = mine[np.isin(mine, hits, assume_unique=True)] if len(hits) else mine[:0]
        out.append(B.squeeze_sorted(mine) if len(mine) else None)
    return out


def _ids(table: pa.Table, key: str) -> np.ndarray:
    return pc.fill_null(table.column(key).combine_chunks().cast(pa.int64()), _LAST).to_numpy(zero_copy_only=False)


def _in_order(table: pa.Table, key: str, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows in order of (id, start), with their documents, places in them and ids."""
    doc = np.searchsorted(starts, at, "right") - 1
    every = _ids(table, key)
    inside, ids = at - starts[doc], every[doc]
    if (every[1:] == every[:-1]).any():
        order = np.lexsort((inside, ids))
        at, doc, inside, ids = at[order], doc[order], inside[order], ids[order]
    return at, doc, inside, ids


def _send_windows(window: int, ranges: int, bits: int, key: str):
    width = _anchor_width(window)

    def send(pages: Iterator[pa.Table], replies: list[bytes]) -> B.Sent:
        if not replies:
            return []
        hits = np.sort(np.concatenate([B.unsqueeze_sorted(x) for x in replies]))
        found: list[tuple[np.ndarray, ...]] = []
        for table in pages:
            _, words, starts = B.block_words(table)
            at = B.places(starts, window)
            if not len(at):
                continue
            tops = B.rolling(words, width) >> np.uint64(64 - bits)
            at, doc, inside, ids = _in_order(table, key, starts, at)
            block = starts[doc] + -(-inside // width) * width
            hit = np.zeros(len(tops), bool)
            own = np.unique(block)
            pos = np.searchsorted(hits, tops[own])
            hit[own] = (pos < len(hits)) & (hits[np.minimum(pos, len(hits) - 1)] == tops[own])
            go = hit[block]
            full, first, n = np.unique(B.rolling(words, window)[at[go]], return_index=True, return_counts=True)
            found.append((full, ids[go][first], inside[go][first].astype(np.uint32), n > 1))
        if not found:
            return []
        full, ids, where, again = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((where, ids, full))
        full, ids, where, again = full[order], ids[order], where[order], again[order]
        lead = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]])) if len(full) else np.zeros(0, np.int64)
        again = (np.add.reduceat(again.astype(np.int64) + 1, lead) > 1) if len(lead) else again
        full, ids, where = full[lead], ids[lead], where[lead]
        cut = B.cuts(full, 64, ranges)
        return [(i, _packed(B.squeeze_sorted(full[a:b]), B.squeeze(ids[a:b]), B.squeeze(where[a:b]), B.squeeze(again[a:b].astype(np.uint8)))) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]

    return send


def _packed(*columns: bytes) -> bytes:
    return np.array([len(columns), *(len(x) for x in columns)], "<u8").tobytes() + b"".join(columns)


def _unpacked(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data[:8], "<u8")[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(data[8 : 8 * (n + 1)], "<u8")).astype(np.int64)
    return [data[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _open_windows(data: bytes) -> tuple[np.ndarray, ...]:
    full, *rest = _unpacked(data)
    return B.unsqueeze_sorted(full), *(B.unsqueeze(x, t) for x, t in zip(rest, (np.int64, np.uint32, np.uint8), strict=False))


def _answer_windows(sent: list[bytes]) -> list[bytes | None]:
    """To each block the window hashes that begin earlier elsewhere, and the beginnings of those that it repeats itself."""
    each = [_open_windows(x) for x in sent]
    full, ids, where = (np.concatenate(x) for x in list(zip(*each, strict=True))[:3])
    order = np.lexsort((where, ids, full))
    full, ids, where = full[order], ids[order], where[order]
    lead = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]]))
    full, ids, where = full[lead], ids[lead], where[lead]
    out = []
    for h, i, w, again in each:
        at = np.searchsorted(full, h)
        later = (i > ids[at]) | ((i == ids[at]) & (w > where[at]))
        own = ~later & (again > 0)
        some = later.any() or own.any()
        out.append(_packed(B.squeeze_sorted(h[later]), B.squeeze_sorted(h[own]), B.squeeze(i[own]), B.squeeze(w[own])) if some else None)
    return out


def _told(replies: list[bytes]) -> tuple[np.ndarray, ...]:
    """(later, hash, id, place): sorted hashes of which every window goes, and the windows that stay of other repeated ones."""
    each = [_unpacked(x) for x in replies]
    join = lambda parts, t: np.concatenate([*parts, np.zeros(0, t)])
    later = np.sort(join([B.unsqueeze_sorted(x[0]) for x in each], np.uint64))
    full = join([B.unsqueeze_sorted(x[1]) for x in each], np.uint64)
    ids, where = (join([B.unsqueeze(x[k], t) for x in each], t) for k, t in ((2, np.int64), (3, np.uint32)))
    order = np.argsort(full)
    return later, full[order], ids[order], where[order]


def _in(values: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are there, and where."""
    if not len(sorted_):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return sorted_[at] == values, at


def _removed(table: pa.Table, told: tuple[np.ndarray, ...], window: int, key: str) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each document of a page, where each starts, and which words go."""
    texts, words, starts = B.block_words(table)
    gone = np.zeros(len(words) + 1, np.int32)
    at = B.places(starts, window)
    later, full, first_id, first_at = told
    if len(at) and (len(later) or len(full)):
        at, _, inside, ids = _in_order(table, key, starts, at)
        hashes = B.rolling(words, window)[at]
        go, _ = _in(hashes, later)
        repeated, k = _in(hashes, full)
        if len(full):
            go |= repeated & ((ids != first_id[k]) | (inside != first_at[k]))
        np.add.at(gone, at[go], 1)
        np.add.at(gone, at[go] + window, -1)
    return texts, starts, np.cumsum(gone[:-1]) > 0


def _earlier_passages(blocks: DataFrame, window: int, key: str) -> DataFrame:
    ranges, bits = B.dimensions(blocks)
    hits = B.ask(blocks, _send_anchors(window, ranges, bits), _answer_anchors)
    return B.ask(blocks, _send_windows(window, ranges, bits, key), _answer_windows, hits)


def dedup_digests(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), the digest of the kept words joined by one space."""
    blocks = B.make_blocks(docs, [key, text], text)
    replied = _earlier_passages(blocks, window, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            told = _told(row["replies"])
            for table in B.pages(row["file"]):
                words, starts, gone = _removed(table, told, window, key)
                n_removed, digests = [], []
                for w, a, b in zip(words, starts[:-1], starts[1:], strict=True):
                    out = gone[a:b]
                    n = int(out.sum())
                    kept = w if not n else [x for x, g in zip(w, out.tolist(), strict=True) if not g]
                    n_removed.append(n)
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_pydict({key: table.column(key).combine_chunks(), "n_words": pa.array(np.diff(starts)), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    kind = docs.schema[key].dataType.simpleString()
    return replied.mapInArrow(run, f"`{key}` {kind}, n_words long, n_removed long, kept_sha256 string")


_WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def cut_text(text: str, gone: list[bool]) -> str:
    """The text without the words that go; the white space before each kept word stays."""
    out, last = [], 0
    for m, g in zip(_WORD.finditer(text), gone, strict=True):
        if not g:
            out.append(text[last : m.start()] + m[0])
        last = m.end()
    return "".join(out).strip(" \t\n\r\x0b\x0c")


def dedup_texts(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of docs, the text without repeated passages; documents of which nothing is left go."""
    columns = [key, *(c for c in docs.columns if c != key)]
    blocks = B.make_blocks(docs, columns, text)
    replied = _earlier_passages(blocks, window, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            told = _told(row["replies"])
            for table in B.pages(row["file"]):
                _, starts, gone = _removed(table, told, window, key)
                column = table.column(text).combine_chunks()
                if not gone.any():
                    yield from table.to_batches()
                    continue
                texts, keep = [None if not good else x for x, good in zip(strings(column).to_pylist(), column.is_valid().to_pylist(), strict=True)], []
                for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                    if gone[a:b].any():
                        texts[i] = cut_text(texts[i], gone[a:b].tolist())
                        if not texts[i]:
                            continue
                    keep.append(i)
                table = table.set_column(table.schema.get_field_index(text), text, pa.array(texts, table.schema.field(text).type))
                if "n_chars" in table.column_names:
                    table = table.set_column(table.schema.get_field_index("n_chars"), "n_chars", pc.cast(pc.utf8_length(table.column(text)), table.schema.field("n_chars").type))
                yield from table.take(pa.array(keep, pa.int64())).to_batches()

    schema = docs.select(*columns).schema
    return replied.mapInArrow(run, schema).select(*docs.columns)
