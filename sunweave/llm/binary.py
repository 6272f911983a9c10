"""Operator 8: token ids as flat binary files with 64-bit document offsets.

A shard holds the ids of a run of documents in ascending key order, as little-endian unsigned integers (16-bit where
the vocabulary allows, else 32-bit), and beside it the keys and the offsets: n + 1 unsigned 64-bit numbers of ids before
each document of the shard. The manifest has a row for each shard; the ids before a shard are prefix sums over it. A
shard is written under a name of its own for each attempt, and the manifest names only those of attempts that counted,
so that lost executors and repeated tasks leave at most files that nobody reads.

Defined results: a null text is an empty one (its end id only); documents without a key come first; rows with equal
keys are ordered by their texts; a text is never cut, so that a very long one makes its shard that much larger; ill-formed
UTF-8 is mended first; an empty table gives no shards; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunweave.llm.arrow import settle, slices, strings
from sunweave.llm.tokens import default_path, word_encoder
from sunweave.sources.shared import held_by, new_path, written

BATCH_BYTES = 4 << 20
#: Bytes of text for each shard, about.
SHARD_BYTES = 32 << 20
#: Characters of a text in a bound between shards.
BOUND_CHARS = 64
_MANIFEST = "shard long, ids string, offsets string, keys string, width int, n_docs long, n_ids long"


def _file_system(uri: str):
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri(uri)


@dataclass
class TokenFiles:
    """Written shards: manifest rows in order, each with the ids before it, and the same as a table."""

    spark: SparkSession
    shards: list[dict]
    manifest: DataFrame

    def read(self, key: str = "doc_id", kind: str = "bigint") -> DataFrame:
        """(key, start, n_tokens, ids) of each document, read back from the files, a task for each shard."""
        return self._map(key, kind, "ids binary", lambda ids: ("ids", pa.binary(), [x.tobytes() for x in ids]))

    def digests(self, key: str = "doc_id", kind: str = "bigint") -> DataFrame:
        """(key, start, n_tokens, ids_crc32) of each document, read back from the files."""
        crc = lambda ids: ("ids_crc32", pa.int64(), [zlib.crc32(x.astype("<u4").tobytes()) for x in ids])
        return self._map(key, kind, "ids_crc32 long", crc)

    def _map(self, key: str, kind: str, last: str, made) -> DataFrame:
        schema = f"`{key}` {kind}, start long, n_tokens long, {last}"
        if not self.shards:
            return self.spark.createDataFrame([], schema)
        rows = self.manifest.repartition(len(self.shards))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in batch.to_pylist():
                    ids, offsets = mapped(s["ids"], f"<u{s['width']}"), mapped(s["offsets"], "<u8")
                    keys = pa.ipc.open_stream(_file_system(s["keys"])[0].open_input_stream(_file_system(s["keys"])[1])).read_all()["key"].combine_chunks()
                    for at in range(0, s["n_docs"], 2000):
                        cut = offsets[at : min(at + 2000, s["n_docs"]) + 1].astype(np.int64)
                        name, type_, values = made([ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
                        columns = {key: keys.slice(at, len(cut) - 1), "start": pa.array(cut[:-1] + s["base"]), "n_tokens": pa.array(np.diff(cut)), name: pa.array(values, type_)}
                        yield pa.RecordBatch.from_pydict(columns)

        return rows.mapInArrow(run, schema)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the path is local, else read."""
    fs, path = _file_system(uri)
    if fs.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write_token_files(docs: DataFrame, model: str, end_id: int | None = 2, kind: str | None = None, path: str | None = None, text: str = "text", key: str = "doc_id") -> TokenFiles:
    """Encodes whole texts and writes them in ascending key order; end_id is appended to each document.

    kind: what the vocabulary is expected to be, see ``word_encoder``. Files under a path of the caller's stay; those in the
    shared folder go when neither the result nor a plan that reads them is left.
    """
    spark = docs.sparkSession
    own = path is None
    path = new_path(spark, "tokens") if own else path
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # Bounds are drawn by how texts begin, which is in the order of the texts, so that no sample of whole texts goes to the driver.
    ordered = rows.repartitionByRange(max(1, -(-size // SHARD_BYTES)), F.col("key").asc_nulls_first(), F.substring("text", 1, BOUND_CHARS).asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), F.col("text").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model if os.path.isabs(model) else default_path(model)
        settle()
        encoder = word_encoder(vocabulary, kind)
        largest = max(encoder.tokenizer.get_vocab_size() - 1, end_id or 0)
        width = 2 if largest < 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        name = f"{path}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}"
        fs, base = _file_system(name)
        keys, lengths = [], []
        fs.create_dir(base.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(f"{base}.ids") as out:
            for part in slices(batches, "text", BATCH_BYTES):
                ids, bounds = encoder.encode_column(strings(part.column("text")), end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                lengths.append(np.diff(bounds))
                keys.append(part.column("key"))
        if not lengths:
            fs.delete_file(f"{base}.ids")
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<u8")
        with fs.open_output_stream(f"{base}.offsets") as out:
            out.write(offsets.tobytes())
        table = pa.table({"key": pa.chunked_array(keys)})
        with fs.open_output_stream(f"{base}.keys") as out, pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "ids": f"{name}.ids", "offsets": f"{name}.offsets", "keys": f"{name}.keys", "width": width, "n_docs": len(offsets) - 1, "n_ids": int(offsets[-1])}],
            pa.schema([("shard", pa.int64()), ("ids", pa.string()), ("offsets", pa.string()), ("keys", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
        )

    base, shards = 0, []
    for row in sorted(ordered.mapInArrow(run, _MANIFEST).collect(), key=lambda r: r["shard"]):  # a row for each shard
        shards.append(row.asDict() | {"base": base})
        base += row["n_ids"]
    if shards:
        fs, at = _file_system(path)
        with fs.open_output_stream(f"{at}/manifest.json") as out:
            out.write(json.dumps(shards, indent=1).encode())
    manifest = written(spark.createDataFrame([tuple(s.values()) for s in shards], f"{_MANIFEST}, base long").coalesce(1), "manifest")
    if own:
        held_by(manifest, path)
    return TokenFiles(spark, shards, manifest)
