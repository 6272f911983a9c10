"""Operator 1: mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame operations only.

Sources get targets by weight, none above a multiple of its size. The mix is made of equal-token blocks: their number is
dealt out to the sources by highest quotients target / (2 s - 1), then each source's quota to its shards by their sizes
in the same way. Within a shard the documents stand in a seeded order, their words one after another form the blocks,
and a quota of q from n blocks means q div n passes over all of them plus q mod n blocks at equal distances from a seeded
start, so that a document's share follows from its place by arithmetic: no block is ever made a row.

Shards hold about ``shard_words`` words of one source, so that a hot source has many of them and no task orders a whole
source, while a small source has one: each shard is many blocks, and what its short last block lacks is little of its
target, however large the whole is. Sources, and the shards of one, are ranked and summed by ranges: no task sees all of them.
A shard's quota stops at the words it has times the most a source may give; as its last block counts as whole, at most one
block's words for each shard go missing so.

Defined results: a null text has size 0 and takes nothing; a null source is a source, last in order; a null id is ordered
as an empty one; rows with equal ids stand side by side by size and share equally nothing but their place; sources
without words have target 0; texts of any length are counted whole; ties of quotients go by source, then shard; an empty
table gives an empty table; further columns, whatever their names, are left out (``take`` keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunweave.operators.prefix import running
from sunweave.sources.shared import one_of_repeated, row_key, written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSpec:
    """Weights repeat over the sources in code-point order; share and most are multiples of all sizes, of a source's."""

    weights: tuple[int, ...] = (5, 2, 1)
    share_percent: int = 150
    most: int = 2
    block: int = 128
    shard_words: int = 1_000_000
    seed: str = "mix-1"


def _big(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """(source, rank, source_size, weight, target): targets by weight, the excess over the caps reshared by weight.

    Sorted by cap over weight, the sources at their caps are a prefix, so that running sums replace repeated resharing.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = running(s, [F.col("source").asc_nulls_last()], "rank").withColumn("rank", (F.col("rank") + 1).cast("long"))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, spec.weights)), (F.pmod(F.col("rank") - 1, F.lit(len(spec.weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * spec.most)
    s = written(running(s, [F.col("cap").cast("double") / F.col("weight"), F.col("rank").asc()], sums={"w_before": "weight", "c_before": "cap"}), "sources")
    all_ = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    words = F.lit(all_["n"] * spec.share_percent).cast("long")
    left = words - 100 * F.col("c_before")
    capped = _big(F.col("cap") * 100) * _big(F.lit(all_["w"]) - F.col("w_before")) <= _big(F.col("weight")) * _big(left)
    s = s.withColumn("capped", capped)
    free = s.agg(F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))), F.lit(0)).alias("c"), F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0)).alias("w")).first()
    share = (F.col("weight") * (words - 100 * free["c"])).cast("double") / F.lit(100 * max(1, free["w"])).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return s.select("source", "rank", "source_size", "weight", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], order: str, votes: str, seats: str, out: str) -> DataFrame:
    """Adds the seats of each party by highest quotients votes / (2 s - 1); equal quotients go by order.

    With V votes for N seats and m parties, the last quotient lies between those that V / (N + m + 1) and V / (N - m - 1)
    would end at, so that about three candidate seats a party decide. Their ranks come from one order over all groups, from
    which each group's first is taken, so that no group meets in a task. Group columns aren't null.
    """
    sums = parties.groupBy(*group).agg((F.count("*") + 1).alias("_m"), F.sum(F.col(votes).cast("double")).alias("_all"))
    at = lambda n: F.when(F.col("_all") > 0, F.floor(F.col(votes) * n / F.col("_all") + 0.5)).otherwise(0).cast("long")
    p = parties.join(sums, group)
    p = p.withColumn("_low", F.greatest(F.lit(0).cast("long"), at(F.col(seats) - F.col("_m"))))
    p = written(p.withColumn("_high", F.greatest(F.col("_low"), at(F.col(seats) + F.col("_m")))).drop("_m", "_all"), "parties")
    each = p.select(*group, order, F.col(votes).alias("_votes"), F.explode(F.expr("sequence(_low + 1, greatest(_low + 1, _high))")).alias("_seat"), "_high").where("_seat <= _high")
    quotient = (F.col("_votes") / (2 * F.col("_seat") - 1)).desc_nulls_last()
    ranked = written(running(each, [*map(F.col, group), quotient, F.col(order)], "_rank").select(*group, order, "_rank"), "quotients")
    first = ranked.groupBy(*group).agg(F.min("_rank").alias("_first"))
    first = p.groupBy(*group).agg((F.max(seats) - F.sum("_low")).alias("_open")).join(first, group)
    won = ranked.join(first, group).where(F.col("_rank") - F.col("_first") < F.col("_open")).groupBy(*group, order).agg(F.count("*").alias("_won"))
    return p.join(won, [*group, order], "left").select(*parties.columns, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias(out))


def _hash(spec: MixSpec, c: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"))


def _number(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def document_sizes(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), *carry)


def mix(docs: DataFrame, spec: MixSpec = MixSpec(), text: str = "text", key: str = "doc_id", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) and, to cut texts, the place in the shard and its quota.

    ``passes`` is how often all words of the document are taken, ``extra`` of ``blocks`` blocks from ``first`` are taken
    once more; ``start`` is the document's first word in its shard. ``selected`` tells which blocks those are. Columns to
    carry along order rows of equal ids and sizes.
    """
    sizes = written(document_sizes(docs, text, key, source, carry), "sizes")
    total = sizes.agg(F.sum("size").alias("n")).first()["n"] or 0
    targets = source_targets(sizes, spec).withColumn("all", F.lit(0))
    targets = targets.withColumn("seats", F.lit(int(total * spec.share_percent / 100 / spec.block + 0.5)).cast("long"))
    targets = written(apportion(targets, ["all"], "rank", "target", "seats", "quota").drop("all", "seats"), "targets")
    h = _hash(spec, F.col("doc_id"))
    same = F.col("source").eqNullSafe(F.col("t_source"))
    # Only sources of more than one shard are told, at most one for each shard_words of the whole input.
    several = targets.where(F.col("source_size") > spec.shard_words).select(F.col("source").alias("t_source"), F.ceil(F.col("source_size") / spec.shard_words).cast("long").alias("shards"))
    placed = sizes.join(F.broadcast(several), same, "left").withColumn("h", h)
    placed = placed.withColumn("shard", _number(F.col("h")) % F.coalesce("shards", F.lit(1).cast("long"))).drop("t_source", "shards")
    placed = placed.withColumn("h", F.substring("h", 9, 24))
    small = targets.select(F.col("source").alias("t_source"), "rank", "source_size", "target", "quota")
    parts = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).join(small, same).drop("source", "t_source")
    parts = apportion(parts, ["rank"], "shard", "shard_size", "quota", "shard_quota")
    blocks = F.ceil(F.col("shard_size") / spec.block).cast("long")
    parts = parts.withColumn("blocks", blocks).withColumn("q", F.least("shard_quota", spec.most * F.col("blocks")))
    parts = parts.withColumn("passes", F.when(F.col("blocks") > 0, F.expr("q div blocks")).otherwise(0).cast("long"))
    parts = parts.withColumn("extra", F.when(F.col("blocks") > 0, F.col("q") % F.col("blocks")).otherwise(0).cast("long"))
    first = _number(_hash(spec, F.concat_ws("/", F.col("rank").cast("string"), F.col("shard").cast("string"))))
    parts = parts.withColumn("first", F.when(F.col("blocks") > 0, first % F.greatest(F.col("blocks"), F.lit(1))).otherwise(0))
    parts = parts.join(small.select("t_source", F.col("rank").alias("t_rank")), F.col("rank") == F.col("t_rank")).drop("t_rank", "shard_size", "shard_quota", "quota", "q")
    parts = written(parts.withColumnRenamed("shard", "t_shard"), "parts")
    before = Window.partitionBy("source", "shard").orderBy("h", F.col("doc_id").asc_nulls_first(), "size", *carry).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("start", F.sum("size").over(before) - F.col("size"))
    out = placed.join(parts, same & (F.col("shard") == F.col("t_shard"))).drop("t_source", "t_shard", "h")
    taken = _words_before(spec, F.col("start") + F.col("size")) - _words_before(spec, F.col("start"))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "shard", "start", "passes", "extra", "blocks", "first", *carry)


def _picked(block: Column) -> Column:
    """Number of selected blocks below the given one, but for a constant."""
    return F.floor((block + F.col("first")) * F.col("extra") / F.greatest(F.col("blocks"), F.lit(1))).cast("long")


def selected(block: Column) -> Column:
    """Whether the block is one of the extra ones; in order, they stand at equal distances."""
    return _picked(block + 1) > _picked(block)


def _words_before(spec: MixSpec, word: Column) -> Column:
    """Words taken from a shard before the given word, repeats counted."""
    block = F.floor(word / spec.block).cast("long")
    inside = F.when(selected(block), word - block * spec.block).otherwise(0)
    return (F.col("passes") * word + (_picked(block) - _picked(F.lit(0))) * spec.block + inside).cast("long")


def take(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mix as documents: whole rows as often as they have passes, then a row with the words taken once more.

    Texts of partly taken documents are their words joined by one space; whole ones stay as they are. Rows meet their part
    of the plan by a key of all their columns, so that null and equal ids are taken like others. Of repeated rows one meets
    the parts of all, which gives what each would give. All columns travel in a struct, so that their names can't clash.
    """
    same = row_key(docs)
    plan = mix(docs.select("doc_id", "source", "text", same.alias("row")), spec, carry=("row",))
    plan = written(plan.where("taken > 0").drop("doc_id", "source", "source_size", "target", "shard"), "plan")
    rows = docs.select(same.alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = one_of_repeated(rows, plan, "row").join(plan, "row")
    rows = rows.withColumn("more", F.col("taken") - F.col("passes") * F.col("size"))
    rows = rows.withColumn("copy", F.explode(F.expr("sequence(1, cast(passes AS int) + 1)")))
    rows = rows.where((F.col("copy") <= F.col("passes")) | (F.col("more") > 0))
    some = F.array_join(F.filter(F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0)), lambda w, i: selected(F.floor((F.col("start") + i) / spec.block).cast("long"))), " ")
    whole = (F.col("copy") <= F.col("passes")) | (F.col("more") == F.col("size"))
    rows = rows.select("doc", F.when(whole, F.col("doc.text")).otherwise(some).alias("text"))
    own = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return rows.select(*[own.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH sizes AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
tot AS (SELECT CAST(COALESCE(sum(size), 0) AS BIGINT) AS total FROM sizes),
src0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM sizes GROUP BY source),
src1 AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM src0),
src2 AS (SELECT *, (SELECT 3 * total FROM tot) AS words2, sum(weight) OVER () AS w_all, sum(weight) OVER b AS w_before, sum(cap) OVER b AS c_before
         FROM src1 WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
src3 AS (SELECT *, CAST(2 * cap AS HUGEINT) * (w_all - COALESCE(w_before, 0)) <= CAST(weight AS HUGEINT) * (words2 - 2 * COALESCE(c_before, 0)) AS capped FROM src2),
src4 AS (SELECT source, rank, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
         CAST(weight * 50 * (words2 - 2 * sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) AS DOUBLE) / CAST(100 * sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target FROM src3),
seats AS (SELECT CAST(floor(total * 1.5 / 128 + 0.5) AS BIGINT) AS n FROM tot),
quot AS (SELECT rank, row_number() OVER (ORDER BY target / (2 * s - 1) DESC, rank) AS place
         FROM (SELECT rank, target, unnest(range(1, CAST(floor(target / 128) AS BIGINT) + 3 + (SELECT count(*) FROM src4))) AS s FROM src4 WHERE target > 0)),
quota AS (SELECT rank, count(*) AS quota FROM quot, seats WHERE place <= n GROUP BY rank),
src AS (SELECT src4.*, COALESCE(quota, 0) AS quota FROM src4 LEFT JOIN quota USING (rank)),
nsh AS (SELECT source, greatest(1, CAST(ceil(source_size / 1000000) AS BIGINT)) AS n FROM src0),
placed AS (SELECT sizes.*, CAST('0x' || substr(h, 1, 8) AS BIGINT) % n AS shard
           FROM (SELECT *, md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM sizes) sizes JOIN nsh ON nsh.source IS NOT DISTINCT FROM sizes.source),
shard0 AS (SELECT rank, shard, sum(size) AS shard_size FROM placed JOIN src ON placed.source IS NOT DISTINCT FROM src.source GROUP BY rank, shard),
squot AS (SELECT rank, shard, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * s - 1) DESC, shard) AS place
          FROM (SELECT shard0.*, unnest(range(1, CAST(floor(2 * shard_size / 128) AS BIGINT) + 3 + (SELECT max(n) FROM nsh))) AS s FROM shard0 WHERE shard_size > 0)),
squota AS (SELECT squot.rank, shard, count(*) AS q FROM squot JOIN src ON squot.rank = src.rank WHERE place <= quota GROUP BY squot.rank, shard),
parts AS (SELECT rank, shard, blocks, q // greatest(blocks, 1) AS passes, q % greatest(blocks, 1) AS extra,
                 CAST('0x' || substr(md5('mix-1:' || rank || '/' || shard), 1, 8) AS BIGINT) % greatest(blocks, 1) AS first
          FROM (SELECT shard0.rank, shard0.shard, CAST(ceil(shard_size / 128) AS BIGINT) AS blocks, least(COALESCE(q, 0), 2 * CAST(ceil(shard_size / 128) AS BIGINT)) AS q
                FROM shard0 LEFT JOIN squota ON shard0.rank = squota.rank AND shard0.shard = squota.shard)),
starts AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY substr(h, 9, 24), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS stop FROM placed),
ends AS (SELECT doc_id, size, source_size, target, passes, extra, blocks, first, CAST(stop - size AS BIGINT) AS a, CAST(stop AS BIGINT) AS z
         FROM starts JOIN src ON starts.source IS NOT DISTINCT FROM src.source JOIN parts ON parts.rank = src.rank AND parts.shard = starts.shard),
cum AS (SELECT *, CAST(floor((a // 128 + first) * extra / greatest(blocks, 1)) AS BIGINT) AS pa, CAST(floor((a // 128 + 1 + first) * extra / greatest(blocks, 1)) AS BIGINT) AS pa1,
                  CAST(floor((z // 128 + first) * extra / greatest(blocks, 1)) AS BIGINT) AS pz, CAST(floor((z // 128 + 1 + first) * extra / greatest(blocks, 1)) AS BIGINT) AS pz1 FROM ends)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + 128 * (pz - pa) + CASE WHEN pz1 > pz THEN z % 128 ELSE 0 END - CASE WHEN pa1 > pa THEN a % 128 ELSE 0 END AS BIGINT) AS taken
FROM cum
"""
