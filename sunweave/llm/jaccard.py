"""Operator 3: similarity join of word n-gram sets by exact Jaccard similarity, with vertical partitioning.

The n-grams have a global order, by rounded document frequency and then hash. It is cut into fragments by hash ranges:

1. Documents are cut into n-gram hashes block by block; each fragment counts the document frequencies of its own and
   tells the blocks which of theirs occur in two documents at least. A document similar to another shares at least the
   threshold's part of its n-grams, so that those with fewer shared ones are done, and for the others the shared ones are
   the whole of what can overlap.
2. Equal sets become one class. Of each, the n-grams that come first in the global order (rare ones; as many as may be
   missing, and one) must hit a similar set's; sets that such n-grams connect form a cluster.
3. A cluster is cut into groups of bounded size, by set size (only neighbouring size classes can be similar) and by
   hashing; for each group and each fragment, partial overlaps are counted separately, and summed for each pair of sets.
   Of the links found only a spanning forest of each group leaves the task. A few sets of the cluster are in all of its
   groups, by which near copies hang together at once. Only the sets outside the largest component so found are then
   compared with all groups, in the same way: a large cluster of near copies costs in proportion to its sets, and no link
   between components is left out.
4. Components of the links, by their smallest id.

n-grams are told apart by 64-bit hashes, sets by 128-bit ones. Nothing is capped: frequent n-grams come last in the order
and are needed only between sets that consist of them.

Defined results: a null or empty text has no set and is linked with nothing; a text of fewer than n words is one n-gram;
a null id is passed on and never smallest; rows with equal ids are separate rows of one document; repeated rows each
get a row; texts of any length are taken whole; ill-formed UTF-8 is mended first; an empty table gives an empty table;
further columns, whatever their names, are left out. Clusters of up to GROUP_SETS sets are one group; the
components are the same however clusters are cut.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunweave.llm import blocks as B
from sunweave.llm.arrow import each_row
from sunweave.operators.components import connected_components
from sunweave.sources.shared import held_by, new_path, written

GROUP_SETS = 256
GROUP_HASHES = 400_000
FRAGMENTS = 4
#: Sets of each size class of a large cluster that all its groups compare with.
PIVOTS = 4


def _sets(table: pa.Table, n: int, text: str) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each document."""
    words, flat, starts = B.block_words(table, text, lower=True)
    grams = B.rolling(flat, n)
    out = []
    for w, a, b in zip(words, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif w:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=len(w))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _send(n: int, text: str, ranges: int, bits: int):
    def send(pages: Iterator[pa.Table]) -> B.Sent:
        parts = []
        for table in pages:
            every = np.concatenate([*_sets(table, n, text), np.zeros(0, np.uint64)]) >> np.uint64(64 - bits)
            parts.append(np.unique(every, return_counts=True))
        tops, count = B.merged([t for t, _ in parts], [c for _, c in parts])
        scale = np.minimum(np.log2(np.maximum(count, 1)).astype(np.uint64), np.uint64(15))
        cut = B.cuts(tops, bits, ranges)
        coded = (tops << np.uint64(4)) | scale
        return [(i, B.squeeze_sorted(coded[a:b])) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]

    return send


def _answer(sent: list[bytes]) -> list[bytes | None]:
    """Hashes of n-grams in two documents at least, with the logarithm of about how many."""
    each = [B.unsqueeze_sorted(x) for x in sent]
    every = np.sort(np.concatenate(each))
    tops, index = np.unique(every >> np.uint64(4), return_index=True)
    df = np.add.reduceat(np.left_shift(np.uint64(1), every & np.uint64(15)), index)
    shared, scale = tops[df > 1], np.log2(df[df > 1]).astype(np.uint64)
    out = []
    for x in each:
        mine = x >> np.uint64(4)
        at = np.minimum(np.searchsorted(shared, mine), max(0, len(shared) - 1))
        good = shared[at] == mine if len(shared) else np.zeros(len(mine), bool)
        out.append(B.squeeze_sorted((mine[good] << np.uint64(6)) | scale[at[good]]) if good.any() else None)
    return out


_LISTED = pa.schema([("digest", pa.binary()), ("shared", pa.list_(pa.int64()))])


def _shared_sets(docs: DataFrame, n: int, percent: int, text: str, key: str) -> DataFrame:
    """(key, size, digest, prefix, hashes, file): for sets that may have a partner, where their shared n-grams are listed.

    digest, prefix (how many of the first in order may have to hit), hashes (how many are shared) and file are null for the
    others. The lists, in the global order, stay in a file a block, from which the few that are needed are read by the tasks
    that need them, so that lists of copies and of sets without near ones are never shuffled.
    """
    blocks = B.make_blocks(docs, [key, text], text)
    ranges, bits = B.dimensions(blocks)
    replied = B.ask(blocks, _send(n, text, ranges, bits), _answer)
    path = new_path(docs.sparkSession, "lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            told = np.sort(np.concatenate([*(B.unsqueeze_sorted(x) for x in row["replies"]), np.zeros(0, np.uint64)]))
            tops, scale = told >> np.uint64(6), told & np.uint64(63)
            file = f"{path}/{row['block']}-{uuid.uuid4().hex[:8]}.arrow"
            fs, base = pafs.FileSystem.from_uri(file)
            fs.create_dir(base.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(base) as sink, pa.ipc.new_stream(sink, _LISTED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for table in B.pages(row["file"]):
                    sets = _sets(table, n, text)
                    digests, prefixes, lists = [], [], []
                    for s in sets:
                        mine = s >> np.uint64(64 - bits)
                        at = np.minimum(np.searchsorted(tops, mine), max(0, len(tops) - 1))
                        good = tops[at] == mine if len(tops) else np.zeros(len(s), bool)
                        k = int(good.sum())
                        if not len(s) or 100 * k < percent * len(s):
                            digests.append(None), prefixes.append(None), lists.append(None)
                            continue
                        order = np.lexsort((s[good], scale[at[good]]))
                        digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                        prefixes.append(len(s) - -(-percent * len(s) // 100) + 1 - (len(s) - k))
                        lists.append(s[good][order].view(np.int64))
                    there = [i for i, d in enumerate(digests) if d is not None]
                    out.write_batch(pa.record_batch([pa.array([digests[i] for i in there], pa.binary()), pa.array([lists[i] for i in there], pa.list_(pa.int64()))], schema=_LISTED))
                    yield pa.RecordBatch.from_pydict(
                        {
                            key: table.column(key).combine_chunks(), "size": pa.array([len(s) for s in sets], pa.int64()), "digest": pa.array(digests, pa.binary()), "prefix": pa.array(prefixes, pa.int32()),
                            "hashes": pa.array([None if x is None else len(x) for x in lists], pa.int32()), "file": pa.array([None if x is None else file for x in digests], pa.string()),
                        }
                    )

    kind = docs.schema[key].dataType.simpleString()
    sets = written(replied.mapInArrow(run, f"`{key}` {kind}, size long, digest binary, prefix int, hashes int, file string"), "sets")
    held_by(sets, path)
    return sets


def _listed(file: str, wanted: set[bytes]) -> Iterator[tuple[bytes, np.ndarray]]:
    """The lists of the wanted digests in a file, each once."""
    fs, base = pafs.FileSystem.from_uri(file)
    left = set(wanted)
    with fs.open_input_file(base) as source:
        for batch in pa.ipc.open_stream(source):
            for i in pc.indices_nonzero(pc.is_in(batch.column("digest"), pa.array(list(left), pa.binary()))).to_pylist() if left else ():
                if (digest := batch.column("digest")[i].as_py()) in left:
                    left.remove(digest)
                    yield digest, batch.column("shared")[i].values.to_numpy()


def _group_rows(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows of equal keys in sorted input."""
    held, name = [], None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                if values[start] != name:
                    if held:
                        yield name, pa.Table.from_batches(held)
                    held, name = [], values[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield name, pa.Table.from_batches(held)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group pair and fragment: digests and sizes in order, and the partial overlaps of its pairs, as columns."""
    for (pair, _), table in _group_rows(batches, ["pair", "fragment"]):
        table = table.sort_by([("digest", "ascending")])
        m = table.num_rows
        part = table.column("part").combine_chunks()
        flat = part.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(m), np.diff(part.offsets.to_numpy()))
        _, column, n = np.unique(flat, return_inverse=True, return_counts=True)
        owner, column = owner[n[column] > 1], column[n[column] > 1]
        total = np.zeros((m, m), np.float32)
        if len(column):
            _, column = np.unique(column, return_inverse=True)
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            for low in range(0, int(column[-1]) + 1, 4096):
                a, b = np.searchsorted(column, [low, low + 4096])
                marks = np.zeros((m, min(4096, int(column[-1]) + 1 - low)), np.float32)
                marks[owner[a:b], column[a:b] - low] = 1
                total += marks @ marks.T
        i, j = np.nonzero(np.triu(total, 1))
        packed = [np.ascontiguousarray(x, np.int32).tobytes() for x in (i, j, total[i, j])]
        yield pa.RecordBatch.from_pydict({"pair": pa.array([pair]), "m": pa.array([m], pa.int32()), "digests": pa.array([table.column("digest").to_pylist()], pa.list_(pa.binary())), "sizes": pa.array([table.column("size").to_pylist()], pa.list_(pa.int64())), "i": pa.array([packed[0]], pa.binary()), "j": pa.array([packed[1]], pa.binary()), "n": pa.array([packed[2]], pa.binary())})


def _links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _group_rows(batches, ["pair"]):
            rows = table.to_pylist()
            m, digests, sizes = rows[0]["m"], rows[0]["digests"], np.array(rows[0]["sizes"])
            i, j, n = (np.concatenate([np.frombuffer(r[c], np.int32) for r in rows]).astype(np.int64) for c in ("i", "j", "n"))
            pairs, inverse = np.unique(i * m + j, return_inverse=True)
            total = np.bincount(inverse, weights=n, minlength=len(pairs)).astype(np.int64) if len(pairs) else np.zeros(0, np.int64)
            i, j = pairs // m, pairs % m
            linked = 100 * total >= percent * (sizes[i] + sizes[j] - total)
            root = np.arange(m)
            forest: list[tuple[int, int]] = []
            for a, b in zip(i[linked].tolist(), j[linked].tolist(), strict=True):
                x, y = a, b
                while root[x] != x:
                    root[x] = x = root[root[x]]
                while root[y] != y:
                    root[y] = y = root[root[y]]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    forest.append((a, b))
            if forest:
                yield pa.RecordBatch.from_pydict({"src": pa.array([digests[a] for a, _ in forest], pa.binary()), "dst": pa.array([digests[b] for _, b in forest], pa.binary())})

    return run


def _group_links(leads: DataFrame, pairs: DataFrame, percent: int, n: int) -> DataFrame:
    """(src, dst) digests of a spanning forest of the links within each group of pairs: (d, pairs), a class and its groups."""
    shift = np.uint64(64 - (FRAGMENTS - 1).bit_length())

    def cut(table: pa.Table) -> pa.Table:
        """The lists of one file's classes, cut by the fragments of the order, for each of their groups."""
        of = {d: (size, groups) for d, size, groups in zip(*(table.column(c).to_pylist() for c in ("digest", "size", "pairs")), strict=True)}
        rows: list[tuple] = []
        for digest, shared in _listed(table.column("file")[0].as_py(), set(of)):
            size, groups = of[digest]
            fragment = shared.view(np.uint64) >> shift
            for v in range(FRAGMENTS):
                part = shared[fragment == v]
                rows += [(pair, digest, size, v, part) for pair in groups]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table({c: pa.array(x, t) for c, x, t in zip(("pair", "digest", "size", "fragment", "part"), columns, (pa.string(), pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int64())), strict=True)})

    rows = leads.select("digest", "size", "file").join(pairs.withColumnRenamed("d", "digest"), "digest")
    rows = rows.repartition(n, "file").groupBy("file").applyInArrow(cut, "pair string, digest binary, size long, fragment int, part array<long>")
    partial = rows.repartition("pair", "fragment").sortWithinPartitions("pair", "fragment").mapInArrow(_overlaps, "pair string, m int, digests array<binary>, sizes array<long>, i binary, j binary, n binary")
    return written(partial.repartition("pair").sortWithinPartitions("pair").mapInArrow(_links(percent), "src binary, dst binary"), "links")


def _heads(table: pa.Table) -> pa.Table:
    """(digest, h): of one file's classes the n-grams that come first in the order."""
    prefix = dict(zip(table.column("digest").to_pylist(), table.column("prefix").to_pylist(), strict=True))
    found = [(d, shared[: prefix[d]]) for d, shared in _listed(table.column("file")[0].as_py(), set(prefix))]
    digests = pa.array([d for d, _ in found], pa.binary()).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for _, x in found])))
    return pa.table({"digest": digests, "h": pa.array(np.concatenate([*(x for _, x in found), np.zeros(0, np.int64)]), pa.int64())})


def _parts(sets: DataFrame, name: str) -> DataFrame:
    """(cluster, level, name): into how many groups of bounded size the sets of a level go."""
    n = sets.groupBy("cluster", "level").agg(F.count("*").alias("n"), F.sum("hashes").alias("h"))
    return n.select("cluster", "level", F.greatest(F.ceil(F.col("n") / GROUP_SETS), F.ceil(F.col("h") / GROUP_HASHES)).cast("int").alias(name))


def _group(parts: str) -> Column:
    return F.pmod(F.xxhash64("digest"), F.col(parts)).cast("int")


def _beside(df: DataFrame) -> DataFrame:
    """Rows with each level that theirs can have links to, as to."""
    return df.withColumn("to", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)))


def _set_roots(leads: DataFrame, percent: int, n: int) -> DataFrame:
    """(node, root): components of the links between different sets, for the digests of sets that have any.

    leads has a row for each class of equal sets, so that copies meet nowhere; n-grams come from the file it names.
    """
    posts = leads.where("prefix > 0").select("file", "digest", "prefix").repartition(n, "file").groupBy("file").applyInArrow(_heads, "digest binary, h long")
    posts = written(posts, "posts")
    first = posts.groupBy("h").agg(F.min("digest").alias("lead"), F.max("digest").alias("last")).where("lead <> last")
    near = posts.join(first, "h").where("digest <> lead").select(F.col("digest").alias("src"), F.col("lead").alias("dst")).distinct()
    cluster = connected_components(near).withColumnRenamed("root", "cluster")
    sets = written(leads.join(cluster, F.col("digest") == F.col("node")).select("cluster", "digest", "size", "hashes"), "members")
    weights = sets.groupBy("cluster").agg(F.count("*").alias("c_sets"), F.sum("hashes").alias("c_hashes"))
    small = (F.col("c_sets") <= GROUP_SETS) & (F.col("c_hashes") <= GROUP_HASHES)
    large = written(weights.where(~small).select("cluster"), "large")
    step = math.log(100 / (percent - 0.1))
    level = F.floor(F.log(F.col("size").cast("double")) / step).cast("int")
    # Sets of a small cluster are one group; those of a large one are dealt out by size and hash.
    whole = sets.join(large, "cluster", "left_anti").select(F.col("digest").alias("d"), F.array(F.hex("cluster")).alias("pairs"))
    if large.isEmpty():
        return connected_components(_group_links(leads, whole, percent, n))
    sets = written(sets.join(large, "cluster", "left_semi").withColumn("level", level), "large_members")
    parts = written(_parts(sets, "parts"), "parts")
    sets = written(sets.join(parts, ["cluster", "level"]).withColumn("g", _group("parts")), "grouped")
    # Each group has some sets of its level and of those beside it along, by which groups of near copies hang together.
    drawn = F.array_distinct(F.array(*[f"m{i}" for i in range(PIVOTS)]))
    pivots = sets.groupBy("cluster", "level").agg(*[F.min(F.struct(F.xxhash64("digest", F.lit(i)).alias("h"), "digest"))["digest"].alias(f"m{i}") for i in range(PIVOTS)])
    pivots = _beside(pivots.select("cluster", "level", F.explode(drawn).alias("digest"))).select("cluster", F.col("to").alias("level"), "digest").join(parts, ["cluster", "level"])
    name = lambda *c: F.concat_ws(":", F.hex("cluster"), *c)
    own = sets.select(F.col("digest").alias("d"), name("level", "g").alias("pair"))
    along = pivots.select(F.col("digest").alias("d"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("g"), "cluster", "level").select("d", name("level", "g").alias("pair"))
    each = lambda df: df.groupBy("d").agg(F.collect_set("pair").alias("pairs"))
    links = _group_links(leads, whole.unionByName(each(own.unionByName(along))), percent, n)
    root = connected_components(links)
    # What is left are links out of all but the largest component of a cluster: those sets meet every group.
    sets = written(sets.join(root, F.col("digest") == F.col("node"), "left").withColumn("root", F.coalesce("root", "digest")).drop("node"), "rooted")
    most = sets.groupBy("cluster", "root").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("most"))
    rest = written(sets.join(most, "cluster").where("root <> most").drop("most", "parts", "g"), "rest")
    if rest.isEmpty():
        return root
    others = written(_parts(rest, "others"), "others")
    rest = rest.join(others, ["cluster", "level"]).withColumn("o", _group("others"))
    groups = parts.select("cluster", F.col("level").alias("to"), "parts")
    out = _beside(rest.select("cluster", "level", "digest", "o")).join(groups, ["cluster", "to"]).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    there = _beside(others).join(sets.select("cluster", F.col("level").alias("to"), "digest", "g"), ["cluster", "to"]).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    met = [df.select(F.col("digest").alias("d"), name("level", "o", "to", "g").alias("pair")) for df in (out, there)]
    more = _group_links(leads, each(met[0].unionByName(met[1])), percent, n)
    return connected_components(links.unionByName(more))


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id): component_id is the smallest id that links of percent similarity reach."""
    sets = _shared_sets(docs, n, percent, text, key)
    some = sets.where("digest IS NOT NULL")
    # Of each class the row with the smallest id, null last, stands for all.
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("least"), "file"))
    least = some.groupBy("digest").agg(first.alias("f"), F.max("size").alias("size"), F.max("hashes").alias("hashes"), F.max("prefix").alias("prefix"))
    least = written(least.select("digest", "f.least", "f.file", "size", "hashes", "prefix"), "classes")
    files = least.select("file").distinct().count()
    root = _set_roots(least, percent, max(1, min(files, 100_000)))
    of = least.join(root, F.col("digest") == F.col("node"), "left").select("digest", "least", F.coalesce("root", "digest").alias("root"))
    component = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(component, "root").select(F.col("digest").alias("d"), "component_id")
    out = sets.select(key, F.col("size").alias("n_shingles"), "digest").join(of, F.col("digest") == F.col("d"), "left")
    return out.select(key, "n_shingles", F.coalesce("component_id", key).alias("component_id"))
