"""Connected components: repeated contraction with DataFrame operations, and one exact last step of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunweave.sources.shared import written

#: As many links, at most, are joined up in one task (some 100 bytes each); more are contracted first.
LAST_LINKS = 500_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, image) of all nodes of the links u, v: image is the smallest node of u's component."""
    root: dict = {}

    def find(x):
        while (y := root.setdefault(x, x)) != x:
            root[x] = x = root[y]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("u").type
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    for i in range(0, len(nodes), 10_000):
        part = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_pydict({"u": pa.array(part, kind), "image": pa.array([find(x) for x in part], kind)})


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", last_links: int = LAST_LINKS) -> DataFrame:
    """(node, root) for each node of undirected edges; root is the smallest node of the component.

    While there are more than last_links links, a round maps each node to the one that comes first among itself and its
    neighbours, in an order drawn anew by hashing, and lets the links follow; links within one image vanish, and so does
    every node that comes first nowhere, so that rounds grow with the logarithm of the number of links over last_links.
    Firsts are aggregated before the shuffle, so that a hub with very many links doesn't meet in one task. The links then
    left are joined up in one task, whose size last_links bounds whatever the input's; no link is left out either way.
    Self-loops, repeated edges and nulls are allowed; an edge with a null end is ignored. An empty input gives an empty
    result.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    link = written(ends.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    kind = link.schema["u"].dataType.simpleString()
    images = None
    for turn in count():
        last = link.count() <= last_links
        if last:
            image = link.coalesce(1).mapInArrow(_joined, f"u {kind}, image {kind}")
        else:
            both = link.unionByName(link.select(F.col("v").alias("u"), F.col("u").alias("v")))
            order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))
            first = both.groupBy("u").agg(F.min(order("v")).alias("m"))
            image = first.select("u", F.least(order("u"), "m")["n"].alias("image"))
        image = written(image, "image")
        if images is None:
            images = image.select(F.col("u").alias("node"), F.col("image").alias("root"))
        else:
            step = image.select(F.col("u").alias("root"), "image")
            images = images.join(step, "root", "left").select("node", F.coalesce("image", "root").alias("root"))
            images = written(images, "images")
        if last:
            break
        left = image.select("u", F.col("image").alias("iu"))
        right = image.select(F.col("u").alias("v"), F.col("image").alias("iv"))
        link = link.join(left, "u").join(right, "v").where("iu <> iv")
        link = written(link.select(F.least("iu", "iv").alias("u"), F.greatest("iu", "iv").alias("v")).distinct(), "links")
    if turn == 0:
        return images  # the last step alone: its roots are the smallest already
    least = images.groupBy("root").agg(F.min("node").alias("least"))
    return images.join(least, "root").select("node", F.col("least").alias("root"))
