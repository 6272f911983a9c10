"""The operators on hostile and awkward input: very long values, ill-formed texts, null and equal ids, clashing names."""

import json
import random
import struct
import time
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from sunweave.llm import binary, blocks, chat, jaccard, media, packing, quality, substring, tokens
from tests.llm.test_operators import brute_cut, brute_groups, words_of

# --- 2 ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("part", [b"%PDF-1 ", b"%PDF-1 startxref ", b"\x1f\x8b\x08\0", b"RIFF    WAVE", b"BM", b"OggS", b"OggS\0\0" + bytes(21), b"fLaC", b"GIF89a", b"%%EOF"])
def test_sniffing_is_linear(part):
    searcher = media.automaton()
    start = time.process_time()
    assert media.sniff_value(part * (4_000_000 // len(part)), searcher) == []
    assert time.process_time() - start < 20


def test_pdf_with_updates():
    one = b"%PDF-1.4\nx\nstartxref\n9\n%%EOF\nmore\nstartxref\n20\n%%EOF"
    data = b"text " + one + b"\nafter %PDF-x " + one + b"tail"
    found = media.sniff_value(data, media.automaton())
    assert [(o, n) for o, n, _ in found] == [(5, len(one)), (data.rindex(b"%PDF-1.4"), len(one))]


def test_ogg_stream_is_one():
    page = lambda flag: b"OggS\0" + bytes([flag]) + bytes(20) + b"\1\3abc"
    data = b"x" + page(2) + page(0) * 3 + page(4) + page(2) + page(0)
    assert media.sniff_value(data, media.automaton()) == [(1, 5 * 31, "audio/ogg"), (1 + 5 * 31, 2 * 31, "audio/ogg")]


def _crc(data, bits, polynomial):
    crc = 0
    for x in data:
        crc ^= x << bits - 8
        for _ in range(8):
            crc = crc << 1 ^ (polynomial if crc >> bits - 1 & 1 else 0)
            crc &= (1 << bits) - 1
    return crc


def test_flac_ends_with_its_last_frame():
    def frame(number, body):
        head = bytes([0xFF, 0xF8, 0x19, 0x00, number])
        data = head + bytes([_crc(head, 8, 0x07)]) + body
        return data + _crc(data, 16, 0x8005).to_bytes(2, "big")

    rng = random.Random(1)
    frames = b"".join(frame(i, rng.randbytes(300)) for i in range(3))
    info = struct.pack(">HH", 192, 192) + bytes(6) + ((44100 << 44) | (1 << 41) | (15 << 36) | 3 * 192).to_bytes(8, "big") + bytes(16)
    flac = b"fLaC" + b"\x80\0\0\x22" + info + frames
    assert media.sniff_value(b"ab" + flac + b"and more", media.automaton()) == [(2, len(flac), "audio/flac")]
    assert media.sniff_value(b"ab" + flac[:-1], media.automaton()) == []


def test_gzip_members_and_bombs():
    bomb = zlib.compressobj(9, wbits=31)
    big = bomb.compress(bytes(20_000_000)) + bomb.flush()
    start = time.process_time()
    found = media.sniff_value(b"\x1f\x8b\x08\0" * 50_000 + big + b"rest", media.automaton())
    assert (200_000, len(big), "application/gzip") in found and time.process_time() - start < 20


# --- 7 ----------------------------------------------------------------------------------------------------------------

DEEP = '{"tool_calls":[{"id":"a","name":"weather","arguments":' + '{"city":' * 2000 + '"x"' + "}" * 2000 + "}]}"
HOSTILE = [
    '{"tool_calls":[{"id":"a","name":"search","arguments":{"query":"x","top_k":1e999}}]}',
    '{"tool_calls":[{"id":"a","name":"search","arguments":{"query":"x","top_k":NaN}}]}',
    '{"tool_calls":[{"id":"a","name":"search","arguments":{"query":"x","top_k":-Infinity}}]}',
    '{"tool_calls":[{"id":"\\ud800","name":"search","arguments":{"query":"x"}}]}',
    '{"tool_calls":[{"id":"a","name":"search","arguments":{"\\udfff":"x"}}]}',
    DEEP,
    "[" * 100_000,
    "{" * 100_000,
    '{"tool_calls":[{"id":"a","name":"search","arguments":{"top_k":' + "9" * 5000 + "}}]}",
]


def test_chat_takes_hostile_json_as_text(spark):
    rows = [(1, i, role, t) for i, t in enumerate(HOSTILE) for role in ("assistant", "tool")] + [(2, 0, "assistant", "x" * 3_000_000)]
    got = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert len(got) == len(rows) and {(r.kind, r.status) for r in got} == {("text", "ok")}
    assert {json.loads(r.json)["content"] for r in got} == {t for *_, t in rows}


def test_chat_argument_texts(spark):
    texts = ['{"city":"x"}', '{"city":NaN}', '{"city":"\\ud800"}', '{"city":' * 500 + "1" + "}" * 500, "[", ""]
    rows = [(i, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "weather", "arguments": t}]})) for i, t in enumerate(texts)]
    got = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert {r.conv_id: r.status.removesuffix("+no_result") for r in got} == {0: "ok"} | {i: "invalid_arguments" for i in range(1, 6)}
    assert all(json.loads(r.json)["tool_call"]["arguments"] == t for r in got if (t := texts[r.conv_id]) and r.conv_id)


def brute_statuses(calls):
    """Status of each call by its definition: {id: refs}."""
    level, missing, changed = {}, set(), True
    while changed:
        changed = False
        for i, refs in calls.items():
            if i not in level and all(r in level for r in refs):
                level[i], changed = 1 + max((level[r] for r in refs), default=-1), True
            if i not in missing and any(r not in calls or r in missing for r in refs):
                missing.add(i)
                changed = True
    return {i: ("missing_dependency" if i in missing else "ok" if i in level else "cycle", level.get(i, 0)) for i in calls}


def test_chat_levels_against_brute_force(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for conv in range(40):
        names = [f"c{i}" for i in range(rng.randrange(1, 9))]
        calls = {n: {rng.choice([*names, "gone"] if rng.random() < 0.1 else names) for _ in range(rng.choice([0, 0, 1, 2]))} for n in names}
        for turn, n in enumerate(rng.sample(names, len(names))):
            args = {"city": "x", "on": [{"$ref": r} for r in sorted(calls[n])]}
            rows.append((conv, turn, "assistant", json.dumps({"tool_calls": [{"id": n, "name": "weather", "arguments": args}]})))
        want |= {(conv, n): s for n, s in brute_statuses(calls).items()}
    got = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert {(r.conv_id, r.call_id): (r.status.removesuffix("+no_result"), r.place_level) for r in got} == want


# --- 3, 6: blocks of several pages ----------------------------------------------------------------------------------------


def passages(n=160):
    """Documents of which many share passages, in part or whole, within a page, a block and beyond."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(400)}"
    shared = [[word() for _ in range(rng.choice([18, 25, 60]))] for _ in range(6)]
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.choice([0, 5, 30, 80]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(shared)
        out.append((rng.choice([i, i, 1000 - i, 7, None]), " ".join(w) if i % 13 else (None if i % 2 else "")))
    return out


@pytest.mark.parametrize("block,pages", [(700, 5), (3000, 3), (10**6, 1)])
def test_blocks_of_pages(spark, monkeypatch, block, pages):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "_grown", lambda base, most, total: pages * base if base == block else 5000)
    texts = passages()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    made = blocks.make_blocks(docs, ["doc_id", "text"])
    seen = [sum(1 for _ in blocks.pages(r.file)) for r in made.collect()]
    assert max(seen) > 1 or pages == 1
    gone, want = brute_cut(texts, 20), Counter()
    for (i, t), g in zip(texts, gone):
        want[i, len(words_of(t)), sum(g)] += 1
    assert any(sum(g) for g in gone)
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substring.dedup_digests(docs).collect())
    assert got == want
    kept = Counter((r.doc_id, len(words_of(r.text))) for r in substring.dedup_texts(docs).collect())
    assert kept == Counter((i, len(g) - sum(g)) for (i, _), g in zip(texts, gone) if not g or not all(g))
    groups = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs, 3, 60).collect())
    assert groups == brute_groups(texts, 3, 60)


def test_ill_formed_texts_are_mended(spark):
    bad = spark.createDataFrame([(1, bytearray(b"caf\xe9 x " * 60)), (2, bytearray("café x ".encode() * 60)), (3, bytearray(b"\xff"))], "doc_id long, b binary").selectExpr("doc_id", "cast(b AS string) AS text", "'a' AS source")
    mended = (b"caf\xe9 x " * 60).decode(errors="replace")
    assert {r.doc_id: r.n_bytes for r in tokens.token_counts(bad, "piece_bpe_32k.model").collect()} == {1: len(mended.encode()), 2: 480, 3: 3}
    assert {r.doc_id: r.n_words for r in quality.ledger(bad).collect()} == {1: 120, 2: 120, 3: 1}
    for name, made in (("byte_bpe_50k.json", lambda: binary.write_token_files(bad, "byte_bpe_50k.json", None).digests()), ("word_bpe_49k.json", lambda: packing.pack(bad, "word_bpe_49k.json", 1))):
        ids = tokens.load(tokens.default_path(name)).encode(mended, add_special_tokens=False).ids
        got = next(r for r in made().collect() if r.doc_id == 1)
        assert (got.n_tokens if "n_tokens" in got.asDict() else got.length - 1) == len(ids)
    assert substring.dedup_texts(bad).count() == 3 and jaccard.similar_groups(bad).count() == 3
    assert {r.doc_id: r.n_bytes for r in media.features(media.store_texts(bad)).collect()}[3] == 3
    rows = bad.selectExpr("doc_id AS conv_id", "1 AS turn", "'user' AS role", "text")
    assert chat.format_chat(rows).count() == 3


# --- vocabularies ---------------------------------------------------------------------------------------------------------


def test_unknown_vocabularies_go_through_the_library_whole(tmp_path):
    with open(tokens.default_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        d = json.load(f)
    d["pre_tokenizer"]["add_prefix_space"] = True
    own = tmp_path / "own.json"
    own.write_text(json.dumps(d))
    assert tokens.vocabulary_form(str(own))[0] is None and tokens.vocabulary_form(tokens.default_path("byte_bpe_50k.json"))[0] == "bytes"
    encoder, library = tokens.word_encoder(str(own)), tokens.load(str(own))
    texts = ["Hello there, world\nx", "", "a  b", "<|endoftext|> x"]
    ids, bounds = encoder.encode_column(pa.array(texts), 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    asked = tokens.word_encoder(tokens.default_path("word_bpe_49k.json"), "bytes")
    assert asked.form is None and asked.encode([b"Hello"])[0] == asked._library(["Hello"])[0]


def test_encoder_on_empty_columns():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        ids, bounds = tokens.word_encoder(tokens.default_path(name)).encode_column(pa.array([], pa.string()), 1)
        assert ids.tolist() == [] and bounds.tolist() == [0]
        ids, bounds = tokens.word_encoder(tokens.default_path(name)).encode_column(pa.array(["", ""]), 1)
        assert ids.tolist() == [1, 1] and bounds.tolist() == [0, 1, 2]


@pytest.mark.parametrize("pivots", [1, 4])
def test_large_clusters_that_are_no_group(spark, monkeypatch, pivots):
    """Chains in which only neighbours are similar, near copies of several bases, and sets that share rare n-grams only."""
    monkeypatch.setattr(jaccard, "GROUP_SETS", 6)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rng = random.Random(3)
    stream = [f"s{i}" for i in range(400)]
    texts = [stream[3 * i : 3 * i + 60] for i in range(70)]
    for b in range(3):
        base = [f"b{b}x{i}" for i in range(50 + 20 * b)] + ["common", "words", "of", "all", "bases"]
        texts += [[w if rng.random() > 0.015 else f"e{rng.randrange(50)}" for w in base] for _ in range(30)]
    docs = [(rng.randrange(10_000), " ".join(t)) for t in texts]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string"), 4, 80).collect())
    assert got == brute_groups(docs, 4, 80)


def test_near_copies_meet_in_few_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 10)
    rng, seen = random.Random(5), []
    base = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join(w if rng.random() > 0.004 else f"e{rng.randrange(30)}" for w in base)) for i in range(400)]
    count = jaccard._group_links

    def counted(leads, pairs, percent, n):
        seen.append(pairs.selectExpr("explode(pairs) AS p").count())
        return count(leads, pairs, percent, n)

    monkeypatch.setattr(jaccard, "_group_links", counted)
    got = jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string"), 4, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_groups(docs, 4, 80)
    assert sum(seen) < 4 * 400  # all pairs of 40 groups would take 40 * 400
