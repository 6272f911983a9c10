"""Stages of the pipeline on rows with null and equal ids, against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from sunweave.llm import mix, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    t = [prose(rng, 60) for _ in range(9)]
    near = " ".join([*t[0].split()[:-1], "changed"])
    rows = [(7, t[0]), (4, near), (None, near + " too"), (None, t[1]), (None, t[2]), (None, t[2]), (9, t[3]), (9, t[3]), (9, t[3]), (5, t[4]), (5, t[5]), (5, t[0]), (11, None), (None, None), (12, ""), (1, t[6])]
    return [(i, x, "en", ["a", "b", None][k % 3] if i not in (9, None) else "a", len(x or "")) for k, (i, x) in enumerate(rows)]


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def firsts(rows):
    """Of each group of distinct rows the one with the smallest id, nulls last."""
    left, out = list(dict.fromkeys(rows)), []
    while left:
        group, todo = [], [left.pop(0)]
        while todo:
            r = todo.pop()
            group.append(r)
            for o in list(left):
                a, b = shingles(r[1]), shingles(o[1])
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    left.remove(o)
                    todo.append(o)
        out.append(min(group, key=lambda r: (r[0] is None, r[0] or 0)))
    return Counter(out)


def test_near_duplicates(spark, rows):
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert Counter(map(tuple, got.collect())) == firsts(rows)
    assert sum(r[0] is None for r in got.collect()) == 3  # two texts and a null text


def test_near_duplicates_empty(spark):
    assert corpus_pipeline.near_duplicates(spark, spark.createDataFrame([], SCHEMA), "").collect() == []


def test_source_mix(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    plan, taken = Counter(), Counter()
    for r in mix.mix(docs).collect():
        plan[r.doc_id, r.source] += r.taken
    for r in corpus_pipeline.source_mix(spark, docs, "").collect():
        taken[r.doc_id, r.source] += len(r.text.split())
    assert taken == +plan and taken[None, "a"] > 0 and taken[9, "a"] <= 2 * 3 * 60


def test_source_mix_repeated_rows_in_part(spark, rows):
    docs = spark.createDataFrame([r for r in rows if r[0] == 9] * 5 + rows[:1], SCHEMA)
    spec = mix.MixSpec(block=16, shard_words=100)
    plan = Counter()
    for r in mix.mix(docs, spec).collect():
        plan[r.doc_id] += r.taken
    taken = Counter()
    for r in mix.take(docs, spec).collect():
        taken[r.doc_id] += len(r.text.split())
    assert taken == +plan and taken[9] <= 2 * 15 * 60


def test_mix_small_sources_reach_their_targets(spark):
    rng = random.Random(6)
    sized = [("large", 400, 100), ("middle", 40, 60), ("small", 15, 60), (None, 12, 60)]
    docs = [(s, prose(rng, n)) for s, k, n in sized for _ in range(k)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, (s, t) in enumerate(docs)], SCHEMA)
    taken, target, shards = Counter(), {}, {}
    for r in mix.mix(docs, mix.MixSpec(block=16, shard_words=1000)).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        shards.setdefault(r.source, set()).add(r.shard)
    assert all(abs(taken[s] - target[s]) <= 0.03 * target[s] for s in target), (taken, target)
    assert {s: len(x) for s, x in shards.items()} == {"large": 40, "middle": 3, "small": 1, None: 1}


# --- the whole ----------------------------------------------------------------------------------------------------------

#: Names that operators use inside.
CLASHES = ("start", "first", "blocks", "taken", "passes", "extra", "size", "row", "doc", "_row", "more", "copy", "key", "plan", "component_id", "digest", "failed", "n_words", "range")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def good(t):
    w = words(t)
    often = {k for k, n in Counter(zip(w, w[1:], w[2:])).items() if n > 1}
    marked = {j + o for j in range(len(w) - 2) if tuple(w[j : j + 3]) in often for o in range(3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    chars = sum(map(len, w))
    bad = (len(w) < 50, 100 * len(marked) > 50 * len(w), chars < 2 * len(w), chars > 20 * len(w), 10 * len(re.findall(r"[#*$%&|<>]", t or "")) > len(w), 100 * (len(lines) - len(set(lines))) > 30 * len(lines))
    return not any(bad)


def without_repeats(rows, window=20):
    """(doc_id, kept words) of documents of which something is left, or nothing was there."""
    first = {}
    rank = lambda i: (i is None, i or 0)
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, (rank(i), s)), (rank(i), s))
    out = Counter()
    for i, t in rows:
        w = words(t)
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (rank(i), s):
                gone.update(range(s, s + window))
        if not w or len(gone) < len(w):
            out[i, tuple(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """Documents of the smallest scale with null and equal ids, null and empty texts, and clashing names."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 17 == 3, None).when(F.col("doc_id") % 19 == 4, 7).otherwise(F.col("doc_id")))
    docs = docs.withColumn("text", F.when(F.length("text") % 23 == 1, None).when(F.length("text") % 29 == 1, "").otherwise(F.col("text")))
    docs = docs.withColumn("source", F.when(F.length("text") % 5 == 0, None).otherwise(F.col("source")))
    docs = docs.unionByName(docs.where("doc_id % 11 = 1"))
    docs.select("*", *[F.lit("x").alias(c) for c in CLASHES]).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_against_brute_force(spark, documents):
    names = ["doc_id", "text", "source"]
    docs = spark.read.parquet(f"{documents}/documents.parquet")
    columns = docs.columns
    every = lambda df: [tuple(r) for r in df.select(*names).collect()]
    before, results = every(docs), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, documents)
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        docs = corpus_pipeline.written(docs, name)
        results.append(docs)
    kept = [r for r in before if good(r[1])]
    assert Counter(every(results[0])) == Counter(kept)
    single = firsts(kept)
    assert Counter(every(results[1])) == single
    assert Counter((i, tuple(words(t))) for i, t, _ in every(results[2])) == without_repeats([(i, t) for i, t, _ in single.elements()])
    plan, taken = Counter(), Counter()
    for r in mix.mix(results[2]).collect():
        plan[r.doc_id, r.source] += r.taken
    for i, t, s in every(results[3]):
        taken[i, s] += len(words(t))
    assert taken == +plan
    tokenizer, want = tokens.load(tokens.default_path("word_bpe_49k.json")), Counter()
    for i, t, _ in every(results[3]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            want[i, k // 4096, zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())] += 1
    got = results[4].collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    again = corpus_pipeline.run(spark, documents)
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, again.select(*pick).collect())) == Counter(map(tuple, results[4].select(*pick).collect()))


def test_stages_on_an_empty_table(spark, documents):
    docs = spark.read.parquet(f"{documents}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, documents).collect() == []
