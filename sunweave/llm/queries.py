"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunweave.llm import binary, chat, jaccard, license, media, mix, packing, quality, substring, tokens
from sunweave.sources.shared import written


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written(media.store_texts(_documents(spark, sf_dir)), "media")
    return media.features(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "true_type", "n_embedded")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_documents(spark, sf_dir), n=4, percent=85)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), "word_bpe_49k.json", end_id=1, capacity=4096)


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_documents(spark, sf_dir))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_digests(_documents(spark, sf_dir))


def _tool_turns(turns: DataFrame) -> DataFrame:
    """All turns, at three times their number, and for each of the assistant's a turn of two calls and a result.

    The conversations have no tool calls of their own; these, by arithmetic on the conversation's id and the turn, have all
    that the operator tells apart: results that answer, come again or answer nothing, arguments that break their schema,
    calls in chains, in cycles and after missing ones.
    """
    t, case = F.col("turn"), F.pmod("conv_id", F.lit(7))
    name = lambda letter, n: F.concat(F.lit(letter), n.cast("string"))
    on = F.when(case == 3, name("c", t)).when(case == 4, name("c", t.bitwiseXOR(F.lit(2)))).when(case == 5, F.lit("gone")).when((case == 6) & (t % 8 > 1), name("c", t - 2)).otherwise(name("s", t))
    search = F.struct(name("s", t).alias("id"), F.lit("search").alias("name"), F.to_json(F.struct(F.col("text").alias("query"), F.pmod(F.length("text"), F.lit(120)).alias("top_k"))).alias("arguments"))
    count = F.struct(name("c", t).alias("id"), F.lit("calculator").alias("name"), F.to_json(F.struct(F.struct(on.alias("$ref")).alias("expression"))).alias("arguments"))
    answer = F.pmod("conv_id", F.lit(5))
    of = F.when(answer == 0, F.lit("zz")).when(answer == 1, name("c", t)).when(answer == 2, F.lit("s1")).otherwise(name("s", t))
    call = F.to_json(F.struct(F.array(search, count).alias("tool_calls")))
    result = F.to_json(F.struct(of.alias("tool_call_id"), F.col("text").alias("content")))
    asked = turns.where("role = 'assistant'")
    at = lambda df, n, role, text: df.select("conv_id", (t * 3 + n).alias("turn"), role.alias("role"), text.alias("text"))
    return at(turns, 0, F.col("role"), F.col("text")).unionByName(at(asked, 1, F.col("role"), call)).unionByName(at(asked, 2, F.lit("tool"), result))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(_tool_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op8_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.write_token_files(_documents(spark, sf_dir), "byte_bpe_50k.json", end_id=2).digests()


def op9_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_documents(spark, sf_dir), "piece_bpe_32k.model")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(_documents(spark, sf_dir))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.rejected(quality.BASE).alias("base_failed"), (~quality.rejected(quality.PROSE)).alias("kept"), F.col("failed"),
    )


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ablation(quality.ledger(_documents(spark, sf_dir)), quality.PROSE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_mix, op2_media, op3_jaccard, op4_packing, op5_license, op6_substring, op7_chat, op8_binary, op9_counts, op10_quality, quality_ablation)
    return {f.__name__: f for f in named}


_WORDS = r"regexp_extract_all(COALESCE({}, ''), '[^\x20\x09-\x0D]+')"

_LE32 = "unhex(substr({0}, 7, 2) || substr({0}, 5, 2) || substr({0}, 3, 2) || substr({0}, 1, 2))"
_OP2 = f"""
WITH t AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
d AS (SELECT doc_id, encode(COALESCE(text, '')) AS b FROM documents),
p AS (SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, greatest(1, CAST(ceil(octet_length(b) / 192.0) AS BIGINT)) * 192 AS n, b FROM d),
q AS (SELECT doc_id, n_bytes, n, b || encode(repeat(' ', CAST(n - n_bytes AS INTEGER))) AS payload FROM p),
m AS (SELECT *, encode('RIFF') || {_LE32.format("printf('%08X', n + 36)")} || encode('WAVEfmt ') || unhex('1000000001000100401F0000401F000001000800') || encode('data') || {_LE32.format("printf('%08X', n)")} || payload AS media FROM q),
v AS (SELECT *, list_transform(regexp_extract_all(hex(payload), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM m)
SELECT doc_id, n_bytes, n AS payload_bytes, sha256(payload) AS payload_sha256, CAST(xor(list_reduce(list_prepend(4294967295, bytes[-16:]), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS BIGINT) AS tail_crc32,
       n + 44 AS media_bytes, sha256(media) AS media_sha256,
       'audio/wav rate=8000 samples=' || n || ' min=' || list_min(bytes) || ' max=' || list_max(bytes) || ' mean=' || CAST(list_sum(bytes) * 1000 // n AS BIGINT) || ' embedded=0' AS feature, 'audio/wav' AS true_type, CAST(0 AS BIGINT) AS n_embedded
FROM v, t
"""

_OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
          JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, COALESCE(n, 0) AS n_shingles, least(d.doc_id, COALESCE(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_OP6 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM later, (SELECT unnest(range(0, 20)) AS o)),
w AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
k AS (SELECT w.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(k.n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

_LEDGER = rf"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3))),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n_rep FROM g, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(COALESCE(n_dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(COALESCE(n_rep, 0) AS BIGINT) AS n_repeat_words, CAST(COALESCE(n_lines, 0) AS BIGINT) AS n_lines
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) | (CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END)
        | (CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END) | (CASE WHEN 10 * n_symbols > n_words THEN 16 ELSE 0 END) | (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END) AS BIGINT) AS failed FROM m)
"""
_OP10 = _LEDGER + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f"
_ABLATION = _LEDGER + "SELECT rule, count(*) FILTER ((failed & bit) <> 0) AS n_failed, count(*) FILTER (failed = bit) AS n_only FROM f, (VALUES ('too_few_words', 1), ('repeated_words', 2), ('short_words', 4), ('long_words', 8), ('symbols', 16), ('repeated_lines', 32)) r(rule, bit) GROUP BY rule"


_OP7 = r"""
WITH t AS (SELECT conv_id, turn, role, text, conv_id % 7 AS case_, conv_id % 5 AS answer FROM conversations),
a AS (SELECT *, length(text) % 120 AS top_k FROM t WHERE role = 'assistant'),
plain AS (SELECT conv_id, turn * 3 AS turn, 'text' AS kind, turn * 3 AS place_turn, 0 AS place_level, 0 AS place_index, 0 AS place_part, CAST(NULL AS VARCHAR) AS call_id, 'ok' AS status,
                 '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":"' || role || '"}' AS json FROM t),
s AS (SELECT conv_id, turn, 's' || turn AS id, 0 AS index, 0 AS level, CASE WHEN top_k BETWEEN 1 AND 100 THEN 'ok' ELSE 'invalid_arguments' END AS state,
             '{"content":null,"role":"assistant","tool_call":{"arguments":{"query":' || CAST(to_json(text) AS VARCHAR) || ',"top_k":' || top_k || '},"id":"s' || turn || '","name":"search"}}' AS json FROM a),
dep AS (SELECT *, CASE case_ WHEN 3 THEN 'c' || turn WHEN 4 THEN 'c' || xor(turn, 2) WHEN 5 THEN 'gone' WHEN 6 THEN CASE WHEN turn % 8 > 1 THEN 'c' || (turn - 2) ELSE 's' || turn END ELSE 's' || turn END AS on_, turn % 8 // 2 AS above FROM a),
chain AS (SELECT d.*, EXISTS (SELECT 1 FROM a o WHERE o.conv_id = d.conv_id AND (on_ = 's' || o.turn OR on_ = 'c' || o.turn)) AS known,
                 case_ = 6 AND (SELECT count(*) FROM a o WHERE o.conv_id = d.conv_id AND o.turn BETWEEN d.turn - 2 * above AND d.turn AND (d.turn - o.turn) % 2 = 0) = above + 1 AS whole FROM dep d),
c AS (SELECT conv_id, turn, 'c' || turn AS id, 1 AS index, CASE WHEN case_ = 6 THEN CASE WHEN whole THEN above + 1 ELSE 0 END WHEN case_ IN (3, 4, 5) THEN 0 ELSE 1 END AS level,
             CASE WHEN case_ IN (4, 5) AND NOT known OR case_ = 6 AND NOT whole THEN 'missing_dependency' WHEN case_ IN (3, 4) THEN 'cycle' ELSE 'ok' END AS state,
             '{"content":null,"role":"assistant","tool_call":{"arguments":{"expression":{"$ref":"' || on_ || '"}},"id":"c' || turn || '","name":"calculator"}}' AS json FROM chain),
calls AS (SELECT * FROM s UNION ALL SELECT * FROM c),
r AS (SELECT conv_id, turn, CASE answer WHEN 0 THEN 'zz' WHEN 1 THEN 'c' || turn WHEN 2 THEN 's1' ELSE 's' || turn END AS id, text FROM a),
given AS (SELECT conv_id, id, min(turn) AS first FROM r GROUP BY ALL)
SELECT * FROM plain
UNION ALL SELECT conv_id, turn * 3 + 1, 'call', turn * 3 + 1, level, index, 0, id, state || CASE WHEN first IS NULL THEN '+no_result' ELSE '' END, json FROM calls LEFT JOIN given USING (conv_id, id)
UNION ALL SELECT r.conv_id, r.turn * 3 + 2, 'result', CASE WHEN calls.id IS NULL OR calls.turn > r.turn THEN r.turn * 3 + 2 ELSE calls.turn * 3 + 1 END, CASE WHEN calls.id IS NULL OR calls.turn > r.turn THEN 0 ELSE level END,
                 CASE WHEN calls.id IS NULL OR calls.turn > r.turn THEN 0 ELSE index END, 1, r.id, CASE WHEN calls.id IS NULL OR calls.turn > r.turn THEN 'orphan' WHEN first < r.turn THEN 'duplicate_result' ELSE 'ok' END,
                 '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":"tool","tool_call_id":"' || r.id || '"}'
FROM r JOIN given USING (conv_id, id) LEFT JOIN calls ON calls.conv_id = r.conv_id AND calls.id = r.id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": mix.ORACLE, "op2_media": _OP2, "op3_jaccard": _OP3, "op5_license": license.oracle(), "op6_substring": _OP6, "op7_chat": _OP7, "op10_quality": _OP10, "quality_ablation": _ABLATION}
