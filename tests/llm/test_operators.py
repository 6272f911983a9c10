"""The operators against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import io
import json
import random
import re
import wave
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from sunweave.llm import binary, chat, jaccard, license, media, mix, packing, quality, substring, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, row string"


def frame(spark, texts, sources=None):
    """Documents with further columns whose names clash with those that operators use inside."""
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[k], len(t or ""), "k", 7, "r") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words_of(t):
    return WORD.findall(t or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    vocabulary = ["the", "of", "and", "Maß", "élan", "naïve", "x", "日本", "don't", "A1", "#tag", "mid-way", "ÉTÉ", "tab bed"] + [f"w{i}" for i in range(300)]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))
    base = [make(rng.choice([1, 2, 3, 4, 19, 20, 30, 90, 200])) for _ in range(40)]
    passage = make(60)
    out = [*base, base[5], base[5], base[9].upper(), passage, make(30) + "\n" + passage + " " + make(10), passage + " " + passage]
    for _ in range(8):
        w = base[7].split(" ") + make(80).split(" ")
        near = list(w)
        near[rng.randrange(len(near))] = "changed"
        out += [" ".join(w), " ".join(near)]
    out += [None, "", " \n\t ", "a\tb\r\nc\x0bd  e", "double  space\n\nlines \n x ", make(9000), "<|endoftext|> <s> x", " wide space \u0085", "same same same same same same", "l1 x\nl1 x\nl1 x\n\nl2"]
    return [(i * 3 % 97 + 200 * (i // 97), t) for i, t in enumerate(out)] + [(3, out[1]), (3, out[1]), (None, out[2]), (None, passage)]


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect()) if False else Counter(tuple(r[n] for n in names) for r in df.collect())


# --- 1 ----------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
        if not open_:
            return target


def test_mix(spark, texts):
    rng = random.Random(3)
    sources = [rng.choice(["a", "a", "a", "b", "é", "z", None]) for _ in texts]
    docs = frame(spark, texts, sources)
    got = mix.mix(docs, mix.MixSpec(block=16, shard_words=3000)).collect()
    assert len(got) == len(texts)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words_of(t))) for i, t in texts)
    sizes = Counter()
    for (_, t), s in zip(texts, sources):
        sizes[s] += len(words_of(t))
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    shards = Counter(r.source for r in {(r.source, r.shard): r for r in got}.values())
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16 * (1 + shards[s])
    again = mix.mix(docs.repartition(3), mix.MixSpec(block=16, shard_words=3000))
    assert Counter((r.doc_id, r.size, r.taken) for r in again.collect()) == Counter((r.doc_id, r.size, r.taken) for r in got)
    assert mix.mix(docs.limit(0)).collect() == []
    silent = mix.mix(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in silent] == [(0, 0.0, 0)] * 2


def test_mix_seats_are_highest_quotients(spark):
    rng = random.Random(8)
    for m, n in ((1, 5), (4, 9), (7, 40), (12, 3)):
        votes = [rng.choice([0, 1, 5, 50, 900]) for _ in range(m)]
        votes[0] = 17
        quotients = sorted(((-v / (2 * s - 1), i) for i, v in enumerate(votes) for s in range(1, n + 1) if v), key=lambda x: x)[:n]
        want = Counter(i for _, i in quotients)
        df = spark.createDataFrame([(0, i, v, n) for i, v in enumerate(votes)], "g int, i int, v long, n long")
        got = mix.apportion(df, ["g"], "i", "v", "n", "seats").collect()
        assert {r.i: r.seats for r in got} == {i: want[i] for i in range(m)}


def test_mix_take(spark, texts):
    unique = list({i: (i, t) for i, t in texts if i is not None}.values())
    docs = frame(spark, unique)
    spec = mix.MixSpec(block=16, shard_words=3000)
    plan = {r.doc_id: r.taken for r in mix.mix(docs, spec).collect()}
    got = mix.take(docs, spec)
    assert got.columns == docs.columns
    taken = Counter()
    for r in got.collect():
        taken[r.doc_id] += len(words_of(r.text))
        assert not Counter(words_of(r.text)) - Counter(words_of(dict(unique)[r.doc_id]))
    assert dict(taken) == {i: n for i, n in plan.items() if n}


# --- 2 ----------------------------------------------------------------------------------------------------------------


def test_media_round_trip(spark, texts):
    docs = frame(spark, texts)
    got = media.features(media.store_texts(docs)).collect()
    want = Counter()
    for i, t in texts:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        want[i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    assert all(r.mismatch and r.true_type == "audio/wav" and r.media_bytes == r.payload_bytes + 44 for r in got)
    for r in media.store_texts(docs).collect():
        with wave.open(io.BytesIO(bytes(r.media))) as w:
            assert (w.getnchannels(), w.getsampwidth()) == (1, 1)
            assert w.readframes(w.getnframes()).rstrip(b" ") == (dict(texts).get(r.doc_id) or "").encode().rstrip(b" ") or r.doc_id in (3, None)
    assert media.features(media.store_texts(docs.limit(0))).collect() == []


def _png():
    chunk = lambda n, d: len(d).to_bytes(4, "big") + n + d + zlib.crc32(n + d).to_bytes(4, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", bytes(13)) + chunk(b"IDAT", zlib.compress(bytes(50))) + chunk(b"IEND", b"")


def _gif():
    return b"GIF89a" + (2).to_bytes(2, "little") * 2 + b"\x80\0\0" + bytes(6) + b"\x2c" + bytes(4) + b"\2\0\2\0\0" + b"\2\2\x4c\1\0" + b"\x3b"


def test_media_carving(spark):
    import gzip

    png, gif, wav, gz = _png(), _gif(), media.encode_wave(b"abc"), gzip.compress(b"hello" * 9)
    bmp = b"BM" + (62).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") * 2 + b"\1\0\x18\0" + bytes(24) + bytes(8)
    values = [(1, png, "image/png"), (2, png[:-3], "image/png"), (3, b"noise BM GIF89a " + gif + b"RIFF" + wav + png, "text/plain"), (4, gz + bmp, "application/gzip"), (5, None, None), (6, b"", "image/gif"), (7, gif, "image/jpeg")]
    table = spark.createDataFrame(values, "doc_id long, media binary, declared string")
    found = media.sniff(table, declared="declared")
    got = {r.doc_id: (r.true_type, r.mismatch, [(f.offset, f.length, f.type) for f in r.found]) for r in found.collect()}
    assert got[1] == ("image/png", False, [(0, len(png), "image/png")])
    assert got[2] == ("unknown", True, [])
    assert got[3] == ("unknown", True, [(16, len(gif), "image/gif"), (20 + len(gif), len(wav), "audio/wav"), (20 + len(gif) + len(wav), len(png), "image/png")])
    assert got[4] == ("application/gzip", False, [(0, len(gz), "application/gzip"), (len(gz), 62, "image/bmp")])
    assert got[5] == ("unknown", False, []) and got[6] == ("unknown", True, []) and got[7][:2] == ("image/gif", True)
    carved = {(r.doc_id, r.offset): bytes(r.bytes) for r in media.carve(table, found).collect()}
    assert carved[3, 16] == gif and carved[4, len(gz)] == bmp


# --- 3 ----------------------------------------------------------------------------------------------------------------


def brute_groups(texts, n, percent):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for _, t in texts:
        w = words_of(lower(t))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        k = len(sets[a] & sets[b])
        if k and 100 * k >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    least = {}
    for a, (i, _) in enumerate(texts):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return Counter((i, len(sets[a]), (least.get(find(a)) if sets[a] else i)) for a, (i, _) in enumerate(texts))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, texts, n, percent):
    got = rows_of(jaccard.similar_groups(frame(spark, texts), n, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute_groups(texts, n, percent)


def test_jaccard_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 5)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        w = list(base[: 90 + i % 30])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        texts.append((i, " ".join(w)))
    got = rows_of(jaccard.similar_groups(frame(spark, texts), 4, 85), "doc_id", "n_shingles", "component_id")
    assert got == brute_groups(texts, 4, 85)
    assert jaccard.similar_groups(frame(spark, texts).limit(0), 4, 85).collect() == []


# --- 4 ----------------------------------------------------------------------------------------------------------------


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path(name))


def test_packing(spark, texts):
    tokenizer = library("word_bpe_49k.json")
    docs = frame(spark, texts)
    for capacity in (4096, 64):
        got = packing.pack(docs, "word_bpe_49k.json", 1, capacity).collect()
        want = Counter()
        for i, t in texts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
            for k in range(0, len(ids), capacity):
                part = ids[k : k + capacity]
                want[i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        filled = {}
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == filled.get(r.sequence_id, 0)
            filled[r.sequence_id] = r.offset + r.length
        assert max(filled.values()) <= capacity
        assert len(filled) <= -(-sum(r.length for r in got) // capacity) + 1
    assert packing.pack(docs.limit(0), "word_bpe_49k.json").collect() == []


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for capacity in (10, 50, 400):
        h = {rng.randrange(1, capacity + 1): rng.choice([1, 2, 7, 1000]) for _ in range(capacity // 3)}
        used = Counter()
        n = 0
        for shape, times in packing.make_plan(h, capacity):
            assert sum(shape) <= capacity and times > 0
            n += times
            for x in shape:
                used[x] += times
        assert dict(used) == h
        assert n <= 1.25 * max(sum(k * v for k, v in h.items()) / capacity, sum(v for k, v in h.items() if 2 * k > capacity)) + 1
    assert packing.make_plan({7: 3, 3: 1, 2: 1, 1: 4}, 10) in ([((7, 3), 1), ((7, 2, 1), 1), ((7, 1, 1, 1), 1)], [((7, 3), 1), ((7, 1, 2), 1), ((7, 1, 1, 1), 1)])


# --- 5 ----------------------------------------------------------------------------------------------------------------


def test_license(spark):
    t = license.TEMPLATES
    readme = "\n\n".join(["word other " * 40] * 3 + [t["MIT"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")] + ["more prose here " * 30])
    texts = [(1, "Foo bar.\nReleased under the MIT license!\nmore"), (2, t["MIT"].replace("TORT", "X")), (3, None), (4, ""), (5, "nothing here to see at all, and more"), (6, "A title\n\n" + t["Apache-2.0-header"][:250] + "\n" + t["Apache-2.0-header"][251:]), (6, "x\n\n\ny z"), (7, "Released under the MIT License. " * 3), (1, "Foo bar.\nReleased under the MIT license!\nmore"), (None, "Licensed under the MIT License."), (None, "Released under the MIT License."), (8, "Released under the MIT License."), (8, "Licensed under CC BY 4.0."), (9, readme), (10, "Some line about this. Released under the MIT License. And so on it goes")]
    pairs = {n: {f"{a} {b}" for a, b in zip(license.normal_words(x), license.normal_words(x)[1:])} for n, x in t.items()}
    want = set()
    for i, text in texts:
        if text is None:
            continue
        parts = re.split(r"\n[\x20\x09-\x0D]*\n", text)
        units = [("line", k, u) for k, u in enumerate(text.split("\n"))] + [(f"run{n}", k, "\n".join(parts[k : k + n])) for n in range(2, 6) for k in range(len(parts) - n + 1)]
        units += [("sentence", k, u) for k, u in enumerate(x for line in text.split("\n") for split in [re.split(r"[.!?]+[\x20\x09]+", line)] if len(split) > 1 for x in split)]
        units += [("paragraph", k, u) for k, u in enumerate(parts) if "\n" in u.strip(" \r\t")] + ([("text", 0, text)] if len(parts) > 1 else [])
        for kind, k, u in units:
            w = license.normal_words(u)
            p = {f"{a} {b}" for a, b in zip(w, w[1:])}
            for name, q in pairs.items():
                if p and 2 * len(p & q) >= 0.8 * (len(p) + len(q)):
                    want.add((i, kind, k, name, len(p & q), len(p)))
    got = license.scan(frame(spark, texts)).collect()
    assert Counter((r.doc_id, r.unit, r.unit_no, r.template, r.n_common, r.n_bigrams) for r in got) == Counter(want)
    assert {2, 6, 1, 7, 8, 9, 10, None} <= {r.doc_id for r in got} and {"run3"} <= {r.unit for r in got if r.doc_id == 9 and r.template == "MIT"}
    assert all(r.dice <= 1 for r in got)
    assert license.scan(frame(spark, texts).limit(0)).collect() == []
    many = license.scan(frame(spark, [(1, "x. y\n\n" * 100_000 + "Released under the MIT License."), (2, "permission " * 300_000)])).collect()
    assert {r.doc_id for r in many} == {1}


# --- 6 ----------------------------------------------------------------------------------------------------------------


def brute_cut(texts, window):
    first, order = {}, sorted((i, k) for k, (i, _) in enumerate(texts) if i is not None) + [(None, k) for k, (i, _) in enumerate(texts) if i is None]
    all_words = [words_of(t) for _, t in texts]
    rank = lambda i: (i is None, i or 0)
    for i, k in order:
        w = all_words[k]
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, (rank(i), s)), (rank(i), s))
    out = []
    for (i, _), w in zip(texts, all_words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (rank(i), s):
                gone[s : s + window] = [True] * window
        out.append(gone)
    return out


@pytest.mark.parametrize("window,block", [(20, 8 << 20), (20, 600), (6, 3000)])
def test_substring(spark, texts, monkeypatch, window, block):
    monkeypatch.setattr(substring.B, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring.B, "RANGE_BYTES", 20_000)
    docs = frame(spark, texts).repartition(3)
    got = rows_of(substring.dedup_digests(docs, window), "doc_id", "n_words", "n_removed", "kept_sha256")
    gone = brute_cut(texts, window)
    want = Counter()
    for (i, t), g in zip(texts, gone):
        w = words_of(t)
        want[i, len(w), sum(g), hashlib.sha256(" ".join(x for x, y in zip(w, g) if not y).encode()).hexdigest()] += 1
    assert got == want
    kept = substring.dedup_texts(docs, window)
    assert kept.columns == docs.columns
    want = Counter((i, tuple(x for x, y in zip(words_of(t), g) if not y)) for (i, t), g in zip(texts, gone) if not any(g) or not all(g))
    assert Counter((r.doc_id, tuple(words_of(r.text))) for r in kept.collect()) == want


def test_substring_empty(spark):
    assert substring.dedup_digests(frame(spark, [(1, "x")]).limit(0)).collect() == []


# --- 7 ----------------------------------------------------------------------------------------------------------------


def test_chat(spark):
    call = lambda *c, content=None: json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in c]})
    result = lambda i, c: json.dumps({"tool_call_id": i, "content": c})
    rows = [
        (1, 0, "user", "Wie geht's? é\n\"q\""),
        (1, 1, "assistant", call(("a", "search", {"top_k": 3, "query": "x"}), ("b", "calculator", {"expression": {"$ref": "a"}}), content="hm")),
        (1, 2, "tool", result("b", 2)),
        (1, 3, "tool", result("a", [1, {"z": 1, "a": 2}])),
        (1, 4, "tool", result("a", "again")),
        (1, 5, "assistant", call(("c", "search", {"top_k": 0, "query": "x"}), ("d", "nope", {}), ("a", "search", {"query": "y"}))),
        (1, 6, "tool", result("zz", "orphan")),
        (1, 7, "assistant", call(("e", "calculator", {"expression": {"$ref": "f"}}), ("f", "calculator", {"expression": {"$ref": "e"}}), ("g", "calculator", {"expression": {"$ref": "gone"}}))),
        (2, 0, "tool", result("a", "other conversation")),
        (None, None, None, None),
        (3, 0, "assistant", "{not json"),
        (3, 1, "assistant", '{"tool_calls": []}'),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, id int")
    got = chat.format_chat(df).collect()
    by = {(r.conv_id, r.turn, r.call_id): r for r in got}
    assert len(got) == 17
    assert by[1, 0, None].json == '{"content":"Wie geht\'s? é\\n\\"q\\"","role":"user"}'
    assert by[1, 1, "a"].status == "ok" and by[1, 1, "b"].status == "ok"
    assert by[1, 1, "a"].json == '{"content":"hm","role":"assistant","tool_call":{"arguments":{"query":"x","top_k":3},"id":"a","name":"search"}}'
    assert [(r.turn, r.call_id) for r in sorted((r for r in got if r.conv_id == 1 and r.place_turn == 1), key=lambda r: (r.place_level, r.place_index, r.place_part, r.turn))] == [(1, "a"), (3, "a"), (4, "a"), (1, "b"), (2, "b")]
    assert by[1, 3, "a"].status == "ok" and by[1, 4, "a"].status == "duplicate_result" and by[1, 6, "zz"].status == "orphan" and by[2, 0, "a"].status == "orphan"
    assert by[1, 3, "a"].json == '{"content":[1,{"a":2,"z":1}],"role":"tool","tool_call_id":"a"}'
    assert {i: by[1, 5, i].status for i in "cda"} == {"c": "invalid_arguments+no_result", "d": "unknown_tool+no_result", "a": "duplicate_id"}
    assert {i: by[1, 7, i].status for i in "efg"} == {"e": "cycle+no_result", "f": "cycle+no_result", "g": "missing_dependency+no_result"}
    assert by[None, None, None].json == '{"content":null,"role":"unknown"}'
    assert by[3, 0, None].json == '{"content":"{not json","role":"assistant"}'
    assert chat.format_chat(df.limit(0)).collect() == []


# --- 8, 9 ---------------------------------------------------------------------------------------------------------------


def test_binary(spark, texts, monkeypatch):
    monkeypatch.setattr(binary, "SHARD_BYTES", 20_000)
    tokenizer = library("byte_bpe_50k.json")
    docs = frame(spark, texts)
    files = binary.write_token_files(docs, "byte_bpe_50k.json", 2)
    assert len(files.shards) > 1
    want, start = Counter(), 0
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[i, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert rows_of(files.digests(), "doc_id", "start", "n_tokens", "ids_crc32") == want
    assert sum(len(r.ids) for r in files.read().collect()) == 2 * start
    assert binary.write_token_files(docs.limit(0), "byte_bpe_50k.json").digests().collect() == []


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(spark, texts, monkeypatch, name):
    monkeypatch.setattr(tokens, "LONG_BYTES", 50)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t, m=sentencepiece.SentencePieceProcessor(model_file=tokens.default_path(name)): len(m.encode(t))
    else:
        count = lambda t, m=library(name): len(m.encode(t, add_special_tokens=False).ids)
    docs = frame(spark, texts + [(500, " lead  and   trail "), (501, "▁ ▁▁ a ▁b " * 30), (502, ("y" * 60 + "  ") * 9)])
    got = rows_of(tokens.token_counts(docs, name, 100), "doc_id", "n_bytes", "n_tokens", "over_limit")
    every = texts + [(500, " lead  and   trail "), (501, "▁ ▁▁ a ▁b " * 30), (502, ("y" * 60 + "  ") * 9)]
    assert got == Counter((i, len((t or "").encode()), (n := count(t or "")), n > 100) for i, t in every)


def test_word_memory_evicts(texts):
    for name, kind in (("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")):
        memory = tokens.word_encoder(tokens.default_path(name), kind)
        memory.most = 40
        tokenizer = library(name)
        for t in [t or "" for _, t in texts] * 2:
            assert np.frombuffer(memory.encode([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_word_memory_awkward_signs(name, kind):
    signs = ["a", "É", "é", "Ñ", "'", "'s", "'re", " ", "\n", "  ", "\t", "1", ",", ".", "***", "<|", "<|endoftext|>", "|>", "ß", "İ", "ΑΣ", "e\u0301", "\u0301", "\xa0", "\u2003", "日本", "🙂", "\x00", "\x1c", "ª", "×", "_", "ÿ", "ﬁ", "\u212a"]
    rng = random.Random(11)
    every = ["".join(rng.choices(signs, k=rng.randrange(14))) for _ in range(4000)]
    memory, tokenizer = tokens.word_encoder(tokens.default_path(name), kind), library(name)
    for at in range(0, len(every), 300):
        part = every[at : at + 300]
        got = [np.frombuffer(x, "<u4").tolist() for x in memory.encode([x.encode() for x in part])]
        assert got == [tokenizer.encode(x, add_special_tokens=False).ids for x in part]


# --- 10 -----------------------------------------------------------------------------------------------------------------


def test_quality(spark, texts):
    docs = frame(spark, texts)
    book = quality.ledger(docs)
    want = Counter()
    for i, t in texts:
        t = t or ""
        w = words_of(t)
        often = {k for k, n in Counter(zip(w, w[1:], w[2:])).items() if n > 1}
        marked = {j + o for j in range(len(w) - 2) if tuple(w[j : j + 3]) in often for o in range(3)}
        lines = [x for x in t.split("\n") if words_of(x)]
        m = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(marked), len(lines))
        fails = (m[0] < 50, 100 * m[4] > 50 * m[0], m[1] < 2 * m[0], m[1] > 20 * m[0], 10 * m[2] > m[0], 100 * m[3] > 30 * m[5])
        want[i, *m, sum(f << k for k, f in enumerate(fails))] += 1
    assert rows_of(book, "doc_id", *quality.MEASURES, "failed") == want
    table = {r.rule: (r.n_failed, r.n_only) for r in quality.ablation(book, quality.PROSE).collect()}
    for k, rule in enumerate(quality.RULES):
        assert table.get(rule.name, (0, 0)) == (sum(n for m, n in want.items() if m[-1] >> k & 1), sum(n for m, n in want.items() if m[-1] == 1 << k))
    kept = quality.ledger(docs, attach=True).where(~quality.rejected(quality.PROSE)).select("row.*")
    assert kept.columns == docs.columns and kept.count() == sum(n for m, n in want.items() if not m[-1])
    assert quality.ledger(docs.limit(0)).collect() == []
