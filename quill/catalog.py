"""Registered queries over the driver tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the oracle SQL by name. Model outputs that the tables do not hold are
derived with the same projection on both sides (stand-ins).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.functions import text as tx
from quill.operators import bpe, chat, corpus
from quill.session import read_table
from quill.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark, sf, name):
    return read_table(spark, sf, name)


# RE2 form of the split pattern for DuckDB: no possessive quantifiers (the
# classes they guard are disjoint from what follows, so the result is the
# same) and no lookahead branch (exact on text without two adjacent
# whitespace characters, which holds for the driver tables); \s spelled out
# as the Unicode White_Space set Java uses under (?U).
_WS_CLASS = (r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
             r"\x{202F}\x{205F}\x{3000}")


def re2_split_pattern(n_digits: int = 2) -> str:
    ws = "[" + _WS_CLASS + "]"
    return ("(" + r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1," + str(n_digits) + "}"
            + r"| ?[^" + _WS_CLASS + r"\p{L}\p{N}]+[\r\n]*|" + ws + r"*[\r\n]|" + ws + "+" + ")")


_RE2 = re2_split_pattern(2).replace("'", "''")
_DOC_CAP = 10_000


# ---------------------------------------------------------------------------
# Flagship and tokenizer statistics


def chunk_stats_by_lang(spark, sf):
    docs = _t(spark, sf, "documents").select("lang", "text")
    counts = (docs.select("lang", F.explode(bpe.pretokenize_col("text")).alias("chunk"))
              .groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("cnt")))
    return counts.groupBy("lang").agg(
        F.sum("cnt").alias("n_chunks"),
        F.count(F.lit(1)).alias("n_distinct_chunks"),
        F.round(F.sum(F.length("chunk") * F.col("cnt")) / F.sum("cnt"), 6).alias("chars_per_chunk"),
        F.min_by("chunk", F.struct(-F.col("cnt"), F.col("chunk"))).alias("top_chunk"),
        F.max("cnt").alias("top_count"))


register("chunk_stats_by_lang", f"""
WITH c AS (
  SELECT lang, unnest(regexp_extract_all(text, '{_RE2}', 1)) AS chunk
  FROM documents),
g AS (SELECT lang, chunk, count(*) AS cnt FROM c GROUP BY lang, chunk)
SELECT lang, sum(cnt) AS n_chunks, count(*) AS n_distinct_chunks,
       round(sum(length(chunk) * cnt) / sum(cnt), 6) AS chars_per_chunk,
       arg_min(chunk, (-cnt, chunk)) AS top_chunk, max(cnt) AS top_count
FROM g GROUP BY lang
""")(chunk_stats_by_lang)


@register("pretokenize_docs", f"""
SELECT doc_id, len(regexp_extract_all(text, '{_RE2}', 1)) AS n_chunks,
       list_aggregate(list_transform(regexp_extract_all(text, '{_RE2}', 1), lambda c: length(c)), 'sum') AS chunk_chars
FROM documents
""")
def pretokenize_docs(spark, sf):
    d = bpe.pretokenize(_t(spark, sf, "documents"))
    return d.select("doc_id", F.size("chunks").alias("n_chunks"),
                    F.aggregate("chunks", F.lit(0).cast("long"), lambda a, c: a + F.length(c)).alias("chunk_chars"))


@register("chunk_counts", f"""
SELECT chunk, count(*) AS cnt FROM (
  SELECT unnest(regexp_extract_all(text, '{_RE2}', 1)) AS chunk FROM documents) GROUP BY chunk
""")
def chunk_counts_q(spark, sf):
    return bpe.chunk_counts(_t(spark, sf, "documents"))


@register("pair_counts", f"""
WITH c AS (SELECT chunk, count(*) AS cnt FROM (
  SELECT unnest(regexp_extract_all(text, '{_RE2}', 1)) AS chunk FROM documents) GROUP BY chunk),
b AS (SELECT cnt, list_transform(range(octet_length(encode(chunk))),
                 lambda i: ('0x' || substring(hex(chunk), 2 * i + 1, 2))::INT) AS ids FROM c),
p AS (SELECT cnt, unnest(list_transform(range(len(ids) - 1), lambda i: [ids[i + 1], ids[i + 2]])) AS pr
      FROM b WHERE len(ids) >= 2)
SELECT pr[1] AS "left", pr[2] AS "right", sum(cnt) AS cnt FROM p GROUP BY 1, 2
""")
def pair_counts_q(spark, sf):
    return bpe.pair_counts(bpe.words_from_chunks(bpe.chunk_counts(_t(spark, sf, "documents"))))


# ---------------------------------------------------------------------------
# Corpus scans


@register("read_corpus_shards", """
SELECT 'documents.parquet' AS shard, count(*) AS n_docs, sum(length(text)) AS n_chars FROM documents
""")
def read_corpus_q(spark, sf):
    d = files.read_corpus(spark, f"{sf.rstrip('/')}/documents.parquet")
    return d.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).alias("n_chars"))


def _doc_shards(spark, sf):
    # stand-in: the table is one file, so a shard number comes from doc_id
    d = _t(spark, sf, "documents")
    return d.withColumn("shard", F.format_string("shard_%05d.parquet", (F.col("doc_id") / 100).cast("int")))


@register("split_corpus", """
WITH s AS (SELECT doc_id, printf('shard_%05d.parquet', (doc_id // 100)::INT) AS shard FROM documents)
SELECT doc_id, CASE WHEN shard = (SELECT max(shard) FROM s) THEN 'val' ELSE 'train' END AS split FROM s
""")
def split_corpus_q(spark, sf):
    return files.split_column(_doc_shards(spark, sf)).select("doc_id", "split")


@register("stride_groups", """
SELECT doc_id FROM documents WHERE ((doc_id % 100) // 8) % 4 = 1
""")
def stride_q(spark, sf):
    d = _t(spark, sf, "documents").withColumn("row_in_shard", F.col("doc_id") % 100)
    return corpus.stride(d, rank=1, world=4, group_size=8).select("doc_id")


@register("crop_docs", f"""
SELECT doc_id, length(substring(text, 1, {_DOC_CAP})) AS n_chars,
       octet_length(encode(substring(text, 1, {_DOC_CAP}))) AS n_bytes FROM documents
""")
def crop_q(spark, sf):
    d = corpus.crop_text(_t(spark, sf, "documents"), doc_cap=_DOC_CAP)
    return d.select("doc_id", F.length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"))


@register("char_budget", """
SELECT doc_id, chars_before FROM (
  SELECT doc_id, coalesce(sum(length(substring(text, 1, 10000))) OVER (ORDER BY doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chars_before FROM documents)
WHERE chars_before <= 1000000
""")
def char_budget_q(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    return corpus.take_char_budget(d, ["doc_id"], 1_000_000).select("doc_id", "chars_before")


@register("sentences", r"""
WITH s AS (SELECT doc_id, text, string_split(text, '.') AS parts FROM documents),
e AS (SELECT doc_id, text, len(parts) AS n, unnest(range(len(parts))) AS pos, parts FROM s),
f AS (SELECT doc_id, pos, n, text,
             regexp_replace(parts[pos + 1], '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g') AS s
      FROM e)
SELECT doc_id, pos, CASE WHEN pos < n - 1 OR ends_with(text, '.') THEN s || '.' ELSE s END AS sentence
FROM f WHERE s <> ''
""")
def sentences_q(spark, sf):
    return corpus.sentences(_t(spark, sf, "documents"))


@register("shuffle_docs", """
SELECT doc_id, md5('42:' || doc_id) AS shuffle_key FROM documents
""")
def shuffle_q(spark, sf):
    return corpus.shuffle(_t(spark, sf, "documents"), "doc_id", seed=42).select("doc_id", "shuffle_key")


@register("paragraphs", r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
             lambda p: regexp_replace(p, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')),
             lambda p: p <> '') AS paras FROM documents)
SELECT doc_id, unnest(range(len(paras))) AS pos, unnest(paras) AS paragraph FROM s
""")
def paragraphs_q(spark, sf):
    return corpus.paragraphs(_t(spark, sf, "documents"), sep=r"\n")


# speaker stand-in: a paragraph "spoken" by the speaker starts with E (or e)
# followed by letters and then a space, matched case-insensitively and anchored
_SPEAKER = tx.speaker_regex(r"E\p{L}*")


@register("match_speaker", r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
             lambda p: regexp_replace(p, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')),
             lambda p: p <> '') AS paras FROM documents),
u AS (SELECT doc_id, unnest(paras) AS paragraph FROM s)
SELECT doc_id, count(*) AS n_paragraphs,
       sum(CASE WHEN regexp_matches(paragraph, '^(?:[Ee]\pL*)\s*:') THEN 1 ELSE 0 END) AS n_speaker,
       sum(CASE WHEN regexp_matches(paragraph, '^(?i:[e]\pL*)[\t\n\x0B\f\r ]*,') THEN 1 ELSE 0 END) AS n_comma,
       sum(CASE WHEN contains(paragraph, '?') OR starts_with(lower(paragraph), 'to ask ')
                  OR contains(lower(paragraph), ' asked ') OR starts_with(lower(paragraph), 'asked ')
                THEN 1 ELSE 0 END) AS n_question
FROM u GROUP BY doc_id
""")
def match_speaker_q(spark, sf):
    p = corpus.paragraphs(_t(spark, sf, "documents"), sep=r"\n")
    comma = r"(?i)^(?:e\p{L}*)\s*,"
    return p.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_paragraphs"),
        F.sum(tx.match_speaker("paragraph", _SPEAKER).cast("int")).alias("n_speaker"),
        F.sum(F.col("paragraph").rlike(comma).cast("int")).alias("n_comma"),
        F.sum(tx.looks_like_question("paragraph").cast("int")).alias("n_question"))


# Q/A stand-in: speaker = a paragraph whose first word starts with E/e and is
# followed by a comma, since the driver text has no "Name:" labels.
_QA_SPEAKER = r"(?i)^(?:e\p{L}*)\s*,"


@register("qa_pairs", r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
             lambda p: regexp_replace(p, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')),
             lambda p: p <> '') AS paras FROM documents),
u AS (SELECT doc_id, paras, unnest(range(len(paras))) AS pos FROM s),
m AS (SELECT doc_id, pos, paras[pos + 1] AS answer, paras[pos] AS prev,
             regexp_replace(paras[1], '[.?!]+$', '') || '?' AS heading
      FROM u WHERE pos > 0 AND regexp_matches(paras[pos + 1], '^(?i:e\pL*)[\t\n\x0B\f\r ]*,'))
SELECT doc_id, pos,
       CASE WHEN contains(prev, '?') OR starts_with(lower(prev), 'to ask ') OR contains(lower(prev), ' asked ')
                 OR starts_with(lower(prev), 'asked ') THEN prev ELSE heading END AS question,
       answer
FROM m
""")
def qa_pairs_q(spark, sf):
    return corpus.extract_qa_pairs(_t(spark, sf, "documents"), _QA_SPEAKER, sep=r"\n")


# ---------------------------------------------------------------------------
# Answers and programs


@register("extract_answer", r"""
SELECT conv_id, turn,
       CASE WHEN regexp_matches(c, '#### (\-?[0-9\.\,]+)')
            THEN replace(trim(regexp_extract(c, '#### (\-?[0-9\.\,]+)', 1)), ',', '') END AS answer
FROM (SELECT conv_id, turn, text || ' #### ' || length(text) AS c FROM conversations)
""")
def extract_answer_q(spark, sf):
    c = _t(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat("text", F.lit(" #### "), F.length("text")).alias("c"))
    return c.select("conv_id", "turn", tx.extract_answer("c").alias("answer"))


@register("extract_program", r"""
SELECT conv_id, turn,
  CASE WHEN regexp_matches(c, '(?s)```(?:python)?\s*\n(.*?)\n```')
       THEN regexp_replace(regexp_extract(c, '(?s)```(?:python)?\s*\n(.*?)\n```', 1), '^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$', '', 'g')
       ELSE regexp_replace(c, '^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$', '', 'g') END AS program
FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN 'Here:' || chr(10) || '```python' || chr(10) || text || chr(10) || '```' || chr(10) || 'done' ELSE ' ' || text || ' ' END AS c
      FROM conversations)
""")
def extract_program_q(spark, sf):
    c = _t(spark, sf, "conversations")
    wrapped = F.when(F.col("turn") % 2 == 1,
                     F.concat(F.lit("Here:\n```python\n"), F.col("text"), F.lit("\n```\ndone"))) \
        .otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(" ")))
    return c.select("conv_id", "turn", tx.extract_program(wrapped).alias("program"))


# ---------------------------------------------------------------------------
# Conversations

_VALIDATE_SQL = """
WITH a AS (
  SELECT conv_id, count(*) AS n_messages,
         max(CASE WHEN turn = 0 AND role = 'system' THEN 1 ELSE 0 END) AS has_system,
         sum(CASE WHEN role <> (CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) THEN 1 ELSE 0 END) AS viol0,
         sum(CASE WHEN turn >= 1 AND role <> (CASE WHEN (turn - 1) % 2 = 0 THEN 'user' ELSE 'assistant' END)
                  THEN 1 ELSE 0 END) AS viol1,
         max(CASE WHEN turn = 1 THEN role END) AS role1
  FROM conversations GROUP BY conv_id),
r AS (SELECT conv_id, n_messages, concat_ws(';', {checks}) AS reasons FROM a)
SELECT conv_id, n_messages, reasons, reasons = '' AS valid FROM r
"""

register("validate_chat", _VALIDATE_SQL.format(checks="""
  CASE WHEN (CASE WHEN has_system = 1 THEN n_messages - 1 ELSE n_messages END) < 2 THEN 'too_few_messages' END,
  CASE WHEN (CASE WHEN has_system = 1 THEN viol1 ELSE viol0 END) > 0 THEN 'bad_alternation' END"""))(
    lambda spark, sf: chat.validate_conversations(_t(spark, sf, "conversations"), "chat"))
register("validate_jsonl", _VALIDATE_SQL.format(checks="""
  CASE WHEN n_messages < 2 THEN 'too_few_messages' END,
  CASE WHEN viol0 > 0 THEN 'bad_alternation' END"""))(
    lambda spark, sf: chat.validate_conversations(_t(spark, sf, "conversations"), "jsonl"))
register("validate_render", _VALIDATE_SQL.format(checks="""
  CASE WHEN has_system = 1 AND coalesce(role1, '') <> 'user' THEN 'system_not_followed_by_user' END,
  CASE WHEN (CASE WHEN has_system = 1 THEN n_messages - 1 ELSE n_messages END) < 1 THEN 'empty' END,
  CASE WHEN (CASE WHEN has_system = 1 THEN viol1 ELSE viol0 END) > 0 THEN 'bad_alternation' END"""))(
    lambda spark, sf: chat.validate_conversations(_t(spark, sf, "conversations"), "render"))


@register("audit_request_limits", """
WITH a AS (SELECT conv_id, count(*) AS n_messages,
                  sum(CASE WHEN coalesce(length(text), 0) = 0 THEN 1 ELSE 0 END) AS n_empty,
                  max(coalesce(length(text), 0)) AS max_len, sum(coalesce(length(text), 0)) AS total_len,
                  sum(CASE WHEN role NOT IN ('user', 'assistant') THEN 1 ELSE 0 END) AS n_bad_role
           FROM conversations GROUP BY conv_id),
r AS (SELECT conv_id, n_messages, total_len, concat_ws(';',
        CASE WHEN n_messages > 500 THEN 'too_many_messages' END,
        CASE WHEN n_empty > 0 THEN 'empty_message' END,
        CASE WHEN max_len > 8000 THEN 'message_too_long' END,
        CASE WHEN total_len > 32000 THEN 'conversation_too_long' END,
        CASE WHEN n_bad_role > 0 THEN 'invalid_role' END) AS reasons FROM a)
SELECT conv_id, n_messages, total_len, reasons, reasons = '' AS valid FROM r
""")
def audit_limits_q(spark, sf):
    return chat.audit_request_limits(_t(spark, sf, "conversations"))


_MERGE_SQL = """
merged AS (
  SELECT c.conv_id, CASE WHEN s.text IS NOT NULL THEN c.turn - 1 ELSE c.turn END AS turn, c.role,
         CASE WHEN s.text IS NOT NULL AND c.turn = 1 THEN s.text || chr(10) || chr(10) || c.text ELSE c.text END AS text
  FROM conversations c
  LEFT JOIN (SELECT conv_id, text FROM conversations WHERE turn = 0 AND role = 'system') s USING (conv_id)
  WHERE NOT (c.turn = 0 AND c.role = 'system'))
"""


@register("merge_system", "WITH " + _MERGE_SQL + "SELECT conv_id, turn, role, text FROM merged")
def merge_system_q(spark, sf):
    return chat.merge_system(_t(spark, sf, "conversations"))


_SEG_SQL = """
segs AS (
  SELECT conv_id, 0::BIGINT AS seg_no, 'special' AS kind, '<|bos|>' AS value, 0 AS mask FROM (SELECT DISTINCT conv_id FROM {src})
  UNION ALL SELECT conv_id, turn * 3 + 1, 'special', CASE WHEN role = 'user' THEN '<|user_start|>' ELSE '<|assistant_start|>' END, 0 FROM {src}
  UNION ALL SELECT conv_id, turn * 3 + 2, 'text', text, CASE WHEN role = 'user' THEN 0 ELSE 1 END FROM {src}
  UNION ALL SELECT conv_id, turn * 3 + 3, 'special', CASE WHEN role = 'user' THEN '<|user_end|>' ELSE '<|assistant_end|>' END,
                   CASE WHEN role = 'user' THEN 0 ELSE 1 END FROM {src})
"""


@register("render_segments", "WITH " + _MERGE_SQL + "," + _SEG_SQL.format(src="merged")
          + "SELECT conv_id, seg_no, kind, value, mask FROM segs")
def render_segments_q(spark, sf):
    return chat.render_segments(_t(spark, sf, "conversations"))


@register("render_completion_segments", """
WITH lastt AS (SELECT conv_id, max(turn) AS last, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id),
kept AS (SELECT c.* FROM conversations c JOIN lastt l USING (conv_id) WHERE l.last_role = 'assistant' AND c.turn <> l.last),
merged AS (
  SELECT c.conv_id, CASE WHEN s.text IS NOT NULL THEN c.turn - 1 ELSE c.turn END AS turn, c.role,
         CASE WHEN s.text IS NOT NULL AND c.turn = 1 THEN s.text || chr(10) || chr(10) || c.text ELSE c.text END AS text
  FROM kept c
  LEFT JOIN (SELECT conv_id, text FROM kept WHERE turn = 0 AND role = 'system') s USING (conv_id)
  WHERE NOT (c.turn = 0 AND c.role = 'system')),
""" + _SEG_SQL.format(src="merged") + """
SELECT conv_id, seg_no, kind, value, mask FROM segs
UNION ALL SELECT conv_id, max(seg_no) + 1, 'special', '<|assistant_start|>', 0 FROM segs GROUP BY conv_id
""")
def render_completion_q(spark, sf):
    return chat.render_for_completion_segments(_t(spark, sf, "conversations"))


def _tasks(spark, sf):
    docs = _t(spark, sf, "documents").select(F.col("doc_id").alias("local_idx"), F.lit("doc").alias("kind"))
    convs = (_t(spark, sf, "conversations").select("conv_id").distinct()
             .select(F.col("conv_id").alias("local_idx"), F.lit("conv").alias("kind")))
    bench = _t(spark, sf, "benchmark").select(F.col("item_id").alias("local_idx"), F.lit("bench").alias("kind"))
    return docs, convs, bench


@register("mix_tasks", """
WITH u AS (
  SELECT 0 AS task_idx, 0 AS copy, doc_id AS local_idx FROM documents
  UNION ALL SELECT 1, 0, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT 2, 0, item_id FROM benchmark
  UNION ALL SELECT 3, 1, item_id FROM benchmark)
SELECT task_idx, copy, local_idx, row_number() OVER (ORDER BY md5('42:' || task_idx || ':' || copy || ':' || local_idx)) - 1 AS idx
FROM u
""")
def mix_q(spark, sf):
    docs, convs, bench = _tasks(spark, sf)
    return chat.mix([docs, convs, bench, bench], seed=42).select("task_idx", "copy", "local_idx", "idx")


@register("sequence_tasks", """
WITH u AS (
  SELECT 0 AS task_idx, row_number() OVER (ORDER BY doc_id) - 1 AS local_idx FROM documents
  UNION ALL SELECT 1, row_number() OVER (ORDER BY item_id) - 1 FROM benchmark),
s AS (SELECT task_idx, count(*) AS n FROM u GROUP BY task_idx),
o AS (SELECT task_idx, coalesce(sum(n) OVER (ORDER BY task_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM s)
SELECT task_idx, local_idx, off + local_idx AS idx FROM u JOIN o USING (task_idx)
""")
def sequence_q(spark, sf):
    docs = corpus.with_index(_t(spark, sf, "documents").select("doc_id"), ["doc_id"], out="local_idx")
    bench = corpus.with_index(_t(spark, sf, "benchmark").select("item_id"), ["item_id"], out="local_idx")
    return chat.sequence([docs.select("local_idx"), bench.select("local_idx")]).select("task_idx", "local_idx", "idx")


@register("ratio_split", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1 AS rank, count(*) OVER () AS n FROM documents)
SELECT doc_id, rank, CASE WHEN rank >= n - least(greatest(1, floor(n * 0.05)), n - 1) THEN 'val' ELSE 'train' END AS split
FROM r
""")
def ratio_split_q(spark, sf):
    return chat.ratio_split(_t(spark, sf, "documents").select("doc_id"), "doc_id", 0.05, 42) \
        .select("doc_id", "rank", "split")


@register("slice_view", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
WHERE idx >= 5 AND idx < 700 AND (idx - 5) % 3 = 0
""")
def slice_view_q(spark, sf):
    d = corpus.with_index(_t(spark, sf, "documents").select("doc_id"), ["doc_id"])
    return corpus.slice_view(d, "idx", 5, 700, 3).select("doc_id")


# ---------------------------------------------------------------------------
# Packing (token ids without a vocabulary: code points of the text, BOS = 0)

from quill.operators import evals, pack  # noqa: E402


def _cps():
    # one pass over the text: every code point as a one-character match
    cps = F.transform(F.regexp_extract_all("text", F.lit("(?s)(.)"), 1), lambda c: F.ascii(c))
    return F.concat(F.array(F.lit(0)), cps)


def _cp_ids(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", _cps().alias("ids"))


_CP_SQL = """
cp AS (SELECT doc_id, 0 AS p, 0 AS tok FROM documents
       UNION ALL SELECT doc_id, i, unicode(substring(text, i, 1)) FROM documents, range(1, length(text) + 1) r(i)),
st AS (SELECT row_number() OVER (ORDER BY doc_id, p) - 1 AS g, tok FROM cp)
"""


@register("token_offsets", """
SELECT doc_id, coalesce(sum(length(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
FROM documents
""")
def token_offsets_q(spark, sf):
    return pack.token_offsets(_cp_ids(spark, sf), ["doc_id"]).select("doc_id", "offset")


_B, _T = 4, 64


@register("pack_blocks", "WITH " + _CP_SQL + f""",
b AS (SELECT g // {_B * _T + 1} AS block, g % {_B * _T + 1} AS w, tok FROM st),
full_blocks AS (SELECT block FROM b GROUP BY block HAVING count(*) = {_B * _T + 1}),
io AS (SELECT block, w // {_T} AS "row", 'i' AS side, w AS w, tok FROM b WHERE w < {_B * _T}
       UNION ALL SELECT block, (w - 1) // {_T}, 't', w, tok FROM b WHERE w >= 1)
SELECT block, "row",
       md5(string_agg(CASE WHEN side = 'i' THEN tok::VARCHAR END, ',' ORDER BY w)) AS inputs_md5,
       md5(string_agg(CASE WHEN side = 't' THEN tok::VARCHAR END, ',' ORDER BY w)) AS targets_md5,
       sum(CASE WHEN side = 'i' THEN tok END) AS inputs_sum
FROM io WHERE block IN (SELECT block FROM full_blocks) GROUP BY block, "row"
""")
def pack_q(spark, sf):
    p = pack.pack(_cp_ids(spark, sf), _B, _T, ["doc_id"])
    return p.select("block", "row", F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
                    F.md5(F.array_join("targets", ",")).alias("targets_md5"),
                    F.aggregate("inputs", F.lit(0).cast("long"), lambda a, x: a + x).alias("inputs_sum"))


def _conv_ids(spark, sf):
    """Rendered-conversation stand-in: one id per message (its length), mask by role."""
    c = _t(spark, sf, "conversations")
    return (c.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("turn", F.length("text").alias("tok"),
                                                       F.when(F.col("role") == "assistant", 1).otherwise(0)
                                                       .alias("m")))).alias("s"))
            .select(F.col("conv_id").alias("idx"),
                    F.concat(F.array(F.lit(0)), F.transform("s", lambda x: x["tok"])).alias("ids"),
                    F.concat(F.array(F.lit(0)), F.transform("s", lambda x: x["m"])).alias("mask")))


@register("collate_sft", """
WITH s AS (SELECT conv_id AS idx, [0] || list(length(text) ORDER BY turn) AS ids,
                  [0] || list(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END ORDER BY turn) AS mask
           FROM conversations GROUP BY conv_id),
k AS (SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, ids, mask FROM s WHERE len(ids) >= 2),
b AS (SELECT idx // 8 AS batch, idx, ids, mask FROM k),
w AS (SELECT batch, count(*) AS n, max(len(ids)) - 1 AS width FROM b GROUP BY batch HAVING count(*) = 8)
SELECT batch, idx % 8 AS "row", idx,
       md5(array_to_string(ids[1:len(ids) - 1] || list_transform(range(width - (len(ids) - 1)), lambda x: 7), ',')) AS inputs_md5,
       md5(array_to_string(list_transform(range(2, len(ids) + 1), lambda i: CASE WHEN mask[i] = 0 THEN -1 ELSE ids[i] END)
           || list_transform(range(width - (len(ids) - 1)), lambda x: -1), ',')) AS targets_md5
FROM b JOIN w USING (batch)
""")
def collate_sft_q(spark, sf):
    c = pack.collate_sft(_conv_ids(spark, sf), 8, pad_id=7)
    return c.select("batch", "row", "idx", F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
                    F.md5(F.array_join("targets", ",")).alias("targets_md5"))


@register("pad_prompts", """
WITH s AS (SELECT conv_id AS idx, [0] || list(length(text) ORDER BY turn) AS ids FROM conversations GROUP BY conv_id),
b AS (SELECT idx // 16 AS batch, idx, ids FROM s),
w AS (SELECT batch, max(len(ids)) AS width FROM b GROUP BY batch)
SELECT batch, idx, md5(array_to_string(ids || list_transform(range(width - len(ids)), lambda x: 0), ',')) AS padded_md5,
       len(ids) - 1 AS answer_pos
FROM b JOIN w USING (batch)
""")
def pad_prompts_q(spark, sf):
    p = pack.pad_prompts(_conv_ids(spark, sf).select("idx", "ids"), 16, bos_id=0)
    return p.select("batch", "idx", F.md5(F.array_join("padded", ",")).alias("padded_md5"), "answer_pos")


@register("pad_rollouts", """
WITH s AS (SELECT conv_id // 4 AS prompt, conv_id AS sample_no, [0] || list(length(text) ORDER BY turn) AS ids,
                  [0] || list(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END ORDER BY turn) AS mask
           FROM conversations GROUP BY conv_id),
w AS (SELECT prompt, max(len(ids)) AS width FROM s GROUP BY prompt),
p AS (SELECT prompt, sample_no, width, ids || list_transform(range(width - len(ids)), lambda x: 4) AS pi,
             mask || list_transform(range(width - len(mask)), lambda x: 0) AS pm FROM s JOIN w USING (prompt))
SELECT prompt, sample_no, md5(array_to_string(pi[1:width - 1], ',')) AS inputs_md5,
       md5(array_to_string(list_transform(range(2, width + 1), lambda i: CASE WHEN pm[i] = 0 THEN -1 ELSE pi[i] END), ',')) AS targets_md5
FROM p
""")
def pad_rollouts_q(spark, sf):
    c = _conv_ids(spark, sf).select((F.col("idx") / 4).cast("long").alias("prompt"),
                                    F.col("idx").alias("sample_no"), "ids", "mask")
    p = pack.pad_rollouts(c, pad_id=4)
    return p.select("prompt", "sample_no", F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
                    F.md5(F.array_join("targets", ",")).alias("targets_md5"))


def _option_ids(spark, sf):
    # options of an item = lines of an order; ids = part, supplier and quantity
    li = _t(spark, sf, "lineitem")
    return (li.groupBy("l_orderkey", "l_linenumber")
            .agg(F.min("l_partkey").alias("a"), F.min("l_suppkey").alias("b"), F.min("l_quantity").alias("q"))
            .select(F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("option"),
                    F.array(F.lit(1), (F.col("l_orderkey") % 3).cast("int"), (F.col("a") % 2).cast("int"),
                            (F.col("b") % 2).cast("int"), F.col("q").cast("int")).alias("ids")))


_OPT_SQL = """
o AS (SELECT l_orderkey AS item, l_linenumber AS option,
             [1, (l_orderkey % 3)::INT, (min(l_partkey) % 2)::INT, (min(l_suppkey) % 2)::INT, min(l_quantity)::INT] AS ids
      FROM lineitem GROUP BY l_orderkey, l_linenumber),
r AS (SELECT item, arg_min(ids, option) AS ref FROM o GROUP BY item),
c AS (SELECT item, option, len(ids) AS "end",
             coalesce(list_position(list_transform(range(1, least(len({a}), len({b})) + 1), lambda i: {a}[i] <> {b}[i]), true) - 1,
                      least(len(ids), len(ref))) AS cl
      FROM o JOIN r USING (item)),
m AS (SELECT item, min(cl) AS common FROM c GROUP BY item)
"""


@register("option_spans_mc", "WITH " + _OPT_SQL.format(a="ids", b="ref") + """
SELECT item, option, common::INT AS start, "end"::INT AS "end" FROM c JOIN m USING (item)
""")
def option_spans_mc_q(spark, sf):
    return pack.option_spans(_option_ids(spark, sf), "mc")


@register("option_spans_schema", "WITH " + _OPT_SQL.format(a="list_reverse(ids)", b="list_reverse(ref)") + """
SELECT item, option, ("end" - common)::INT AS start, "end"::INT AS "end" FROM c JOIN m USING (item)
""")
def option_spans_schema_q(spark, sf):
    return pack.option_spans(_option_ids(spark, sf), "schema")


@register("crop_left", """
WITH s AS (SELECT conv_id, [0] || list(length(text) ORDER BY turn) AS ids FROM conversations GROUP BY conv_id),
x AS (SELECT conv_id, ids, len(ids) - 2 AS start, len(ids) AS "end", greatest(len(ids) - 3, 0) AS over FROM s)
SELECT conv_id, md5(array_to_string(CASE WHEN over > 0 THEN ids[len(ids) - 2:] ELSE ids END, ',')) AS ids_md5,
       start - over AS start, "end" - over AS "end", (start - over >= 0 AND "end" - over >= 0) AS span_ok
FROM x
""")
def crop_left_q(spark, sf):
    c = _conv_ids(spark, sf).select(F.col("idx").alias("conv_id"), "ids")
    c = c.withColumn("start", F.size("ids") - 2).withColumn("end", F.size("ids"))
    r = pack.crop_left(c, 3)
    return r.select("conv_id", F.md5(F.array_join("ids", ",")).alias("ids_md5"), "start", "end", "span_ok")


# ---------------------------------------------------------------------------
# Evaluation stand-ins


def _token_losses(spark, sf):
    e = _t(spark, sf, "events")
    return e.select((F.col("user_id") % 4).alias("run"), F.col("event_id").alias("pos"),
                    (F.col("event_id") % 300 - 1).cast("int").alias("target_id"), F.abs("value").alias("loss"))


def _token_bytes(spark):
    r = spark.range(300)
    return r.select(F.col("id").cast("int").alias("token_id"),
                    F.when(F.col("id") >= 290, 0).otherwise(1 + F.col("id") % 7).cast("int").alias("n_bytes"))


@register("bits_per_byte", """
WITH l AS (SELECT user_id % 4 AS run, event_id % 300 - 1 AS target_id, abs(value) AS loss FROM events),
tb AS (SELECT range::INT AS token_id, CASE WHEN range >= 290 THEN 0 ELSE 1 + range % 7 END AS n_bytes FROM range(300)),
j AS (SELECT run, loss, CASE WHEN target_id >= 0 THEN coalesce(n_bytes, 0) ELSE 0 END AS nb
      FROM l LEFT JOIN tb ON l.target_id = tb.token_id)
SELECT run, round(sum(CASE WHEN nb > 0 THEN loss ELSE 0 END), 6) AS nats, sum(nb)::BIGINT AS bytes,
       round(CASE WHEN sum(nb) = 0 THEN 'inf'::DOUBLE ELSE sum(CASE WHEN nb > 0 THEN loss ELSE 0 END) / (ln(2) * sum(nb)) END, 6) AS bpb
FROM j GROUP BY run
""")
def bits_per_byte_q(spark, sf):
    return evals.bits_per_byte(_token_losses(spark, sf), _token_bytes(spark), by=["run"])


@register("fewshot_examples", """
WITH p AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos, count(*) OVER () - 1 AS m FROM benchmark),
t AS (SELECT item_id, pos, m, list_transform(range(3), lambda i: floor(('0x' || substring(md5('1234:' || item_id || ':' || i), 1, 8))::UBIGINT::DOUBLE
      / 4294967296.0 * (m - 3 + i + 1))::BIGINT) AS t FROM p),
a AS (SELECT *, t[1] AS r0, CASE WHEN t[2] = t[1] THEN m - 2 ELSE t[2] END AS r1 FROM t),
b AS (SELECT *, CASE WHEN t[3] IN (r0, r1) THEN m - 1 ELSE t[3] END AS r2 FROM a),
k AS (SELECT item_id, pos, j, [r0, r1, r2][j + 1] AS r FROM b, range(3) r(j))
SELECT k.item_id, k.j, p.item_id AS shot_item_id FROM k JOIN p ON k.r + (k.r >= k.pos)::BIGINT = p.pos
""")
def fewshot_q(spark, sf):
    return evals.fewshot_examples(_t(spark, sf, "benchmark").select("item_id"), 3, seed=1234, key="item_id")


@register("score_options", """
WITH m AS (SELECT l_orderkey AS item, l_linenumber AS option, avg(l_extendedprice) AS mean_loss FROM lineitem GROUP BY 1, 2),
p AS (SELECT item, arg_min(option, (mean_loss, option)) AS pred FROM m GROUP BY item)
SELECT item, pred, 1 AS gold, pred = 1 AS is_correct FROM p
""")
def score_options_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    losses = li.select(F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("option"),
                       F.col("l_extendedprice").alias("loss"))
    gold = li.select(F.col("l_orderkey").alias("item")).distinct().withColumn("gold", F.lit(1))
    return evals.score_options(losses, gold)


@register("score_lm", """
SELECT l_orderkey AS item, bool_and(l_suppkey % 3 = l_partkey % 3) AS is_correct FROM lineitem GROUP BY 1
""")
def score_lm_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    p = li.select(F.col("l_orderkey").alias("item"), (F.col("l_suppkey") % 3).alias("pred"),
                  (F.col("l_partkey") % 3).alias("actual"))
    return evals.score_lm(p)


def _outcomes(spark, sf):
    li = _t(spark, sf, "lineitem")
    return (li.groupBy("l_orderkey", "l_linenumber")
            .agg(F.bool_or(F.col("l_returnflag") == "R").alias("is_correct"))
            .select(F.col("l_orderkey").alias("idx"), F.col("l_linenumber").alias("sample_no"), "is_correct"))


_OUT_SQL = """
o AS (SELECT l_orderkey AS idx, l_linenumber AS sample_no, bool_or(l_returnflag = 'R') AS is_correct
      FROM lineitem GROUP BY 1, 2)
"""


@register("task_accuracy", "WITH " + _OUT_SQL + """,
t AS (SELECT 'task' || (idx % 5) AS task, idx, bool_or(is_correct) AS is_correct FROM o GROUP BY 1, 2),
r AS (SELECT task, is_correct, row_number() OVER (PARTITION BY task ORDER BY md5('1337:' || idx)) - 1 AS rk FROM t)
SELECT task, count(*) AS n, round(avg(is_correct::INT::DOUBLE), 6) AS accuracy FROM r WHERE rk < 1000 GROUP BY task
""")
def task_accuracy_q(spark, sf):
    o = _outcomes(spark, sf).groupBy("idx").agg(F.bool_or("is_correct").alias("is_correct"))
    o = o.withColumn("task", F.concat(F.lit("task"), (F.col("idx") % 5).cast("string")))
    return evals.task_accuracy(o, cap=1000, seed=1337)


def _baselines(spark, sf):
    r = _t(spark, sf, "region")
    return r.select(F.concat(F.lit("task"), F.col("r_regionkey").cast("string")).alias("task"),
                    (F.col("r_regionkey") * 10.0).alias("baseline"))


_CENTER_SQL = "WITH " + _OUT_SQL + """,
t AS (SELECT 'task' || (idx % 5) AS task, idx, bool_or(is_correct) AS is_correct FROM o GROUP BY 1, 2),
a AS (SELECT task, count(*) AS n, round(avg(is_correct::INT::DOUBLE), 6) AS accuracy FROM t GROUP BY task),
b AS (SELECT 'task' || r_regionkey AS task, r_regionkey * 10.0 AS baseline FROM region),
c AS (SELECT task, n, accuracy, baseline, round((accuracy - 0.01 * baseline) / (1.0 - 0.01 * baseline), 6) AS centered
      FROM a JOIN b USING (task))
"""


def _centered(spark, sf):
    o = _outcomes(spark, sf).groupBy("idx").agg(F.bool_or("is_correct").alias("is_correct"))
    o = o.withColumn("task", F.concat(F.lit("task"), (F.col("idx") % 5).cast("string")))
    return evals.centered_score(evals.task_accuracy(o), _baselines(spark, sf))


@register("centered_score", _CENTER_SQL + "SELECT task, n, accuracy, baseline, centered FROM c")
def centered_q(spark, sf):
    return _centered(spark, sf).select("task", "n", "accuracy", "baseline", "centered")


@register("core_metric", _CENTER_SQL + """
SELECT task, centered FROM c UNION ALL SELECT 'CORE', round(avg(centered), 6) FROM c
""")
def core_metric_q(spark, sf):
    return evals.core_metric(_centered(spark, sf))


@register("categorical_eval", """
WITH lg AS (SELECT l_orderkey AS item, chr((64 + l_linenumber)::INT) AS letter, max(l_discount) AS logit FROM lineitem GROUP BY 1, 2),
lt AS (SELECT o_orderkey AS item, chr((65 + i)::INT) AS letter, i AS letter_idx FROM orders, range(4) r(i)),
v AS (SELECT lg.item, lg.letter, logit, letter_idx FROM lg JOIN lt ON lg.item = lt.item AND lg.letter = lt.letter),
p AS (SELECT item, arg_max(letter, (logit, -letter_idx)) AS pred FROM v GROUP BY item)
SELECT item, pred, chr(65 + (item % 4)::INT) AS gold, pred = chr(65 + (item % 4)::INT) AS is_correct
FROM p JOIN (SELECT o_orderkey AS item FROM orders) USING (item)
""")
def categorical_eval_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    logits = (li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_discount").alias("logit"))
              .select(F.col("l_orderkey").alias("item"), F.chr(F.col("l_linenumber") + 64).alias("letter"), "logit"))
    orders = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("item"))
    letters = orders.select("item", F.posexplode(F.array(*[F.lit(c) for c in "ABCD"])).alias("letter_idx", "letter"))
    gold = orders.select("item", F.chr(65 + (F.col("item") % 4)).alias("gold"))
    return evals.categorical_eval(logits, letters, gold)


@register("generative_eval", "WITH " + _OUT_SQL + """
SELECT count(*) AS n, round(avg(passed::INT::DOUBLE), 6) AS accuracy
FROM (SELECT idx, bool_or(is_correct) AS passed FROM o GROUP BY idx)
""")
def generative_eval_q(spark, sf):
    return evals.generative_eval(_outcomes(spark, sf))


@register("grade_numeric", r"""
WITH c AS (SELECT conv_id, turn, text || ' #### ' || length(text) AS ref,
                  CASE WHEN turn % 3 = 0 THEN text ELSE text || ' #### ' || (length(text) - turn % 2) END AS pred
           FROM conversations),
x AS (SELECT conv_id, turn,
             CASE WHEN regexp_matches(ref, '#### (\-?[0-9\.\,]+)') THEN replace(trim(regexp_extract(ref, '#### (\-?[0-9\.\,]+)', 1)), ',', '') END AS r,
             CASE WHEN regexp_matches(pred, '#### (\-?[0-9\.\,]+)') THEN replace(trim(regexp_extract(pred, '#### (\-?[0-9\.\,]+)', 1)), ',', '') END AS p
      FROM c)
SELECT conv_id, turn, r IS NOT DISTINCT FROM p AS is_correct FROM x
""")
def grade_numeric_q(spark, sf):
    c = _t(spark, sf, "conversations")
    ref = F.concat("text", F.lit(" #### "), F.length("text"))
    pred = F.when(F.col("turn") % 3 == 0, F.col("text")).otherwise(
        F.concat("text", F.lit(" #### "), (F.length("text") - F.col("turn") % 2).cast("string")))
    return c.select("conv_id", "turn", evals.grade_numeric(ref, pred).alias("is_correct"))


@register("grade_letter", """
SELECT o_orderkey AS item, list_contains(['A', 'B', 'C', 'D'], chr(65 + (o_custkey % 5)::INT))
       AND chr(65 + (o_custkey % 5)::INT) = chr(65 + (o_orderkey % 4)::INT) AS is_correct FROM orders
""")
def grade_letter_q(spark, sf):
    o = _t(spark, sf, "orders")
    ans = F.chr(65 + F.col("o_custkey") % 5)
    ref = F.chr(65 + F.col("o_orderkey") % 4)
    letters = F.array(*[F.lit(c) for c in "ABCD"])
    return o.select(F.col("o_orderkey").alias("item"), evals.grade_letter(ref, ans, letters).alias("is_correct"))


@register("pass_at_k", "WITH " + _OUT_SQL + """,
r AS (SELECT idx, is_correct, row_number() OVER (PARTITION BY idx ORDER BY sample_no) AS rk FROM o),
f AS (SELECT idx, min(CASE WHEN is_correct THEN rk END) AS first_ok FROM r GROUP BY idx)
SELECT k, round(avg(coalesce(first_ok <= k, false)::INT::DOUBLE), 6) AS pass_at_k FROM f, range(1, 9) t(k) GROUP BY k
""")
def pass_at_k_q(spark, sf):
    return evals.pass_at_k(_outcomes(spark, sf), 8).withColumn("k", F.col("k").cast("long"))


@register("chat_core", """
WITH a AS (SELECT CASE (l_linenumber - 1) % 6 + 1 WHEN 1 THEN 'ARC-Easy' WHEN 2 THEN 'ARC-Challenge' WHEN 3 THEN 'MMLU'
                  WHEN 4 THEN 'GSM8K' WHEN 5 THEN 'HumanEval' WHEN 6 THEN 'SpellingBee' END AS task,
                  avg((l_returnflag = 'R')::INT::DOUBLE) AS accuracy
           FROM lineitem GROUP BY 1),
b AS (SELECT * FROM (VALUES ('ARC-Easy', 0.25), ('ARC-Challenge', 0.25), ('MMLU', 0.25), ('GSM8K', 0.0),
                            ('HumanEval', 0.0), ('SpellingBee', 0.0)) t(task, baseline))
SELECT round(avg((accuracy - baseline) / (1.0 - baseline)), 6) AS chatcore FROM a JOIN b USING (task) HAVING count(*) = 6
""")
def chat_core_q(spark, sf):
    names = ["ARC-Easy", "ARC-Challenge", "MMLU", "GSM8K", "HumanEval", "SpellingBee"]
    li = _t(spark, sf, "lineitem")
    task = F.element_at(F.array(*[F.lit(n) for n in names]), ((F.col("l_linenumber") - 1) % 6 + 1).cast("int"))
    accs = li.groupBy(task.alias("task")).agg(F.avg((F.col("l_returnflag") == "R").cast("double")).alias("accuracy"))
    return evals.chat_core(accs)


def _rewards(spark, sf):
    return _outcomes(spark, sf).select(F.col("idx").alias("prompt"), "sample_no",
                                       F.col("is_correct").cast("double").alias("reward"))


_REW_SQL = _OUT_SQL + """,
rw AS (SELECT idx AS prompt, sample_no, is_correct::INT::DOUBLE AS reward FROM o),
adv AS (SELECT prompt, sample_no, reward, reward - avg(reward) OVER (PARTITION BY prompt) AS advantage FROM rw)
"""


@register("group_advantage", "WITH " + _REW_SQL + """
SELECT prompt, sample_no, reward, round(advantage, 6) AS advantage FROM adv
""")
def group_advantage_q(spark, sf):
    a = evals.group_advantage(_rewards(spark, sf))
    return a.select("prompt", "sample_no", "reward", F.round("advantage", 6).alias("advantage"))


@register("policy_objective", "WITH " + _REW_SQL + """,
lp AS (SELECT l_orderkey AS prompt, l_linenumber AS sample_no, -ln(1 + l_discount) AS logp, (l_suppkey % 5) - 1 AS target FROM lineitem)
SELECT prompt, sum((target >= 0)::BIGINT) AS n_valid,
       round(sum(CASE WHEN target >= 0 THEN logp * advantage ELSE 0.0 END) / greatest(sum((target >= 0)::BIGINT), 1), 6) + 0.0 AS pg_obj
FROM lp JOIN adv USING (prompt, sample_no) GROUP BY prompt
""")
def policy_objective_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    lp = li.select(F.col("l_orderkey").alias("prompt"), F.col("l_linenumber").alias("sample_no"),
                   (-F.log(1 + F.col("l_discount"))).alias("logp"), (F.col("l_suppkey") % 5 - 1).alias("target"))
    adv = evals.group_advantage(_rewards(spark, sf))
    return evals.policy_objective(lp, adv, by=["prompt"], keys=["prompt", "sample_no"])


@register("rollout_stats", """
WITH s AS (SELECT l_orderkey % 10 AS step, l_orderkey AS prompt, (l_returnflag = 'R')::INT::DOUBLE AS reward, l_quantity AS seq_len FROM lineitem),
p AS (SELECT step, prompt, avg(reward) AS pm, sum(seq_len) AS sl, count(*) AS n FROM s GROUP BY 1, 2)
SELECT step, round(avg(pm), 6) AS mean_reward, round(sum(sl) / sum(n), 6) AS mean_seq_len FROM p GROUP BY step
""")
def rollout_stats_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    s = li.select((F.col("l_orderkey") % 10).alias("step"), F.col("l_orderkey").alias("prompt"),
                  (F.col("l_returnflag") == "R").cast("double").alias("reward"), F.col("l_quantity").alias("seq_len"))
    return evals.rollout_stats(s)


@register("masked_token_mean", """
SELECT user_id % 4 AS run, round(avg(CASE WHEN event_id % 300 - 1 <> -1 THEN abs(value) END), 6) AS mean_loss,
       sum((event_id % 300 - 1 <> -1)::BIGINT) AS active_tokens FROM events GROUP BY 1
""")
def masked_token_mean_q(spark, sf):
    return evals.masked_token_mean(_token_losses(spark, sf), by=["run"])


def _run_metrics(spark, sf):
    e = _t(spark, sf, "events")
    return e.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"),
                    F.abs("value").alias("loss"), (1 + F.col("value") % 2).alias("dt"))


@register("run_metrics", """
WITH RECURSIVE m AS (SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS t,
                            event_id AS step, abs(value) AS loss, 1 + value % 2 AS dt FROM events),
e(run, t, step, ema, tw) AS (
  SELECT run, t, step, 0.1 * loss, CASE WHEN step > 10 THEN dt ELSE 0.0 END FROM m WHERE t = 0
  UNION ALL
  SELECT m.run, m.t, m.step, 0.9 * e.ema + 0.1 * m.loss, e.tw + CASE WHEN m.step > 10 THEN m.dt ELSE 0.0 END
  FROM e JOIN m ON m.run = e.run AND m.t = e.t + 1)
SELECT run, step, round(ema / (1.0 - pow(0.9, t + 1)), 6) AS ema_loss, round(tw, 6) AS time_after_warmup FROM e
""")
def run_metrics_q(spark, sf):
    r = evals.run_metrics(_run_metrics(spark, sf))
    return r.select("run", "step", "ema_loss", "time_after_warmup")


@register("best_checkpoint", """
SELECT event_type AS run, arg_min(event_id, (abs(value), event_id)) AS best_step, min(abs(value)) AS best_loss
FROM events GROUP BY 1
""")
def best_checkpoint_q(spark, sf):
    m = _run_metrics(spark, sf).withColumnRenamed("loss", "val_loss")
    return evals.best_checkpoint(m)


@register("report_summary", """
WITH kv AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'mid' WHEN 2 THEN 'sft' ELSE 'rl' END AS stage,
                   CASE doc_id % 5 WHEN 0 THEN 'CORE metric' WHEN 1 THEN 'ChatCORE metric' WHEN 2 THEN 'MMLU accuracy'
                                   WHEN 3 THEN 'GSM8K pass@1' ELSE 'total time' END AS logged, doc_id, quality FROM labels),
a AS (SELECT logged, stage, min(doc_id) AS line_no, round(avg(quality), 4)::VARCHAR AS v FROM kv GROUP BY 1, 2),
m AS (SELECT stage, line_no, v, metric FROM a, (SELECT unnest(['CORE', 'MMLU', 'GSM8K', 'ChatCORE']) AS metric)
      WHERE contains(logged, metric) AND CASE stage WHEN 'base' THEN metric = 'CORE' WHEN 'rl' THEN metric = 'GSM8K' ELSE metric <> 'CORE' END),
l AS (SELECT metric, stage, arg_max(v, line_no) AS v FROM m GROUP BY 1, 2)
SELECT metric,
       coalesce(max(CASE WHEN stage = 'base' THEN v END), '-') AS base,
       coalesce(max(CASE WHEN stage = 'mid' THEN v END), '-') AS mid,
       coalesce(max(CASE WHEN stage = 'sft' THEN v END), '-') AS sft,
       coalesce(max(CASE WHEN stage = 'rl' THEN v END), '-') AS rl,
       CASE WHEN metric = 'CORE' THEN 0 WHEN metric = 'ChatCORE' THEN 2 ELSE 1 END AS sort_key
FROM l GROUP BY metric
""")
def report_summary_q(spark, sf):
    lab = _t(spark, sf, "labels")
    stage = F.element_at(F.array(*[F.lit(s) for s in ["base", "mid", "sft", "rl"]]), (F.col("doc_id") % 4 + 1).cast("int"))
    names = ["CORE metric", "ChatCORE metric", "MMLU accuracy", "GSM8K pass@1", "total time"]
    metric = F.element_at(F.array(*[F.lit(s) for s in names]), (F.col("doc_id") % 5 + 1).cast("int"))
    kv = (lab.groupBy(stage.alias("stage"), metric.alias("metric"))
          .agg(F.round(F.avg("quality"), 4).cast("string").alias("value"), F.min("doc_id").alias("line_no"))
          .withColumn("run", F.lit("r0")))
    return evals.report_summary(kv).drop("run")


@register("cost_estimate", """
SELECT p_partkey, round((CASE WHEN contains(p_name, 'H100') THEN 3.0 WHEN contains(p_name, 'A100') THEN 1.79
                            WHEN contains(p_name, 'V100') THEN 0.55 ELSE 2.0 END)::DOUBLE * (p_size % 8 + 1), 6) AS hourly_rate,
       round((CASE WHEN contains(p_name, 'H100') THEN 3.0 WHEN contains(p_name, 'A100') THEN 1.79
                  WHEN contains(p_name, 'V100') THEN 0.55 ELSE 2.0 END)::DOUBLE * (p_size % 8 + 1) * (p_retailprice / 100.0), 6) AS estimated_total
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'NVIDIA H100 80GB' WHEN 1 THEN 'A100-SXM' WHEN 2 THEN 'Tesla V100' ELSE p_name END AS p_name,
             p_size, p_retailprice FROM part)
""")
def cost_estimate_q(spark, sf):
    p = _t(spark, sf, "part")
    name = F.element_at(F.array(F.lit("NVIDIA H100 80GB"), F.lit("A100-SXM"), F.lit("Tesla V100"), F.col("p_name")),
                        (F.col("p_partkey") % 4 + 1).cast("int"))
    runs = p.select("p_partkey", name.alias("device"), (F.col("p_size") % 8 + 1).alias("n_devices"),
                    (F.col("p_retailprice") / 100.0).alias("hours"))
    return evals.cost_estimate(runs).select("p_partkey", "hourly_rate", "estimated_total")


# ---------------------------------------------------------------------------
# Tokenizer training and encoding (oracles: training unrolled in SQL, at the end)

_VOCAB = 256 + 9 + 48
_MERGES_CACHE: dict[tuple[str, int], list] = {}


def trained_merges(spark, sf, vocab_size: int = _VOCAB):
    """Merges trained on the whole documents (result-sized; memoised per run)."""
    key = (sf, vocab_size)
    if key not in _MERGES_CACHE:
        docs = _t(spark, sf, "documents").select("text")
        _MERGES_CACHE[key] = [tuple(r) for r in bpe.train_bpe(docs, vocab_size).collect()]
    return spark.createDataFrame(_MERGES_CACHE[key], "rank INT, left INT, right INT, new_id INT, cnt LONG")


@register("bpe_train")
def bpe_train_q(spark, sf):
    return trained_merges(spark, sf)


def _vocab(spark, sf):
    return bpe.add_special_tokens(bpe.mergeable_ranks(trained_merges(spark, sf)))


@register("mergeable_ranks")
def mergeable_ranks_q(spark, sf):
    return bpe.mergeable_ranks(trained_merges(spark, sf)).select("token_id", F.hex("token_bytes").alias("token_hex"))


@register("vocab_with_specials")
def vocab_q(spark, sf):
    return _vocab(spark, sf).select("token_id", F.hex("token_bytes").alias("token_hex"), "special")


@register("encode_docs")
def encode_q(spark, sf):
    m = trained_merges(spark, sf)
    e = bpe.encode(_t(spark, sf, "documents").select("doc_id", "text"), m, prepend=_VOCAB - 9)
    return e.select("doc_id", F.size("ids").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("ids_md5"))


@register("decode_roundtrip", "SELECT doc_id, md5(text) AS decoded_md5 FROM documents")
def roundtrip_q(spark, sf):
    m = trained_merges(spark, sf)
    e = bpe.encode(_t(spark, sf, "documents").select("doc_id", "text"), m)
    return bpe.decode_bytes(e, _vocab(spark, sf), out="decoded").select("doc_id", F.md5("decoded").alias("decoded_md5"))


@register("token_byte_lengths")
def token_bytes_q(spark, sf):
    return bpe.token_byte_lengths(_vocab(spark, sf))


@register("vocab_stats")
def vocab_stats_q(spark, sf):
    return bpe.vocab_stats(bpe.token_byte_lengths(_vocab(spark, sf)))


@register("count_tokens")
def count_tokens_q(spark, sf):
    return bpe.count_tokens(_t(spark, sf, "documents").select("text"), trained_merges(spark, sf))


@register("compression_report")
def compression_q(spark, sf):
    docs = _t(spark, sf, "documents").select("lang", "text")
    empty = spark.createDataFrame([], "rank INT, left INT, right INT, new_id INT, cnt LONG")
    return bpe.compression_report(docs, {"bytes": empty, "trained": trained_merges(spark, sf)}, by="lang")


@register("training_budget")
def training_budget_q(spark, sf):
    c = bpe.count_tokens(_t(spark, sf, "documents").select("text"), trained_merges(spark, sf))
    return pack.training_budget(c, total_batch_size=524_288, num_params=561_000_000)


# ---------------------------------------------------------------------------
# Synthetic data (word list = distinct lower-case ASCII words of the documents)

from quill.operators import synth  # noqa: E402


def _words(spark, sf):
    return synth.word_list_from_text(_t(spark, sf, "documents"))


_WORDS_SQL = r"""
words AS (SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(lower(text), '(\pL+)', 1)) AS w FROM documents)
          WHERE regexp_matches(w, '^[a-z]+$')),
wl AS (SELECT word, row_number() OVER (ORDER BY md5(word)) - 1 AS word_idx FROM words),
nw AS (SELECT count(*) AS n FROM wl)
"""


def _u(field, expr):
    return f"(('0x' || substring(md5('{field}:' || ({expr})), 1, 8))::UBIGINT::DOUBLE / 4294967296.0)"


def _sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_SB_SQL = "WITH " + _WORDS_SQL + f""",
d AS (SELECT doc_id AS idx, floor({_u('sb-word', 'doc_id')} * (SELECT n FROM nw))::BIGINT AS word_idx,
             {_u('sb-mode', 'doc_id')} AS u_mode, {_u('sb-letter', 'doc_id')} AS u_letter,
             {_u('sb-template', 'doc_id')} AS u_t, {_u('sb-lower', 'doc_id')} AS u_low,
             {_u('sb-lq', 'doc_id')} AS u_lq, {_u('sb-wq', 'doc_id')} AS u_wq, {_u('sb-qmark', 'doc_id')} AS u_q
      FROM documents),
x AS (SELECT d.*, word,
             CASE WHEN u_mode < 0.9 THEN substring(word, (floor(u_letter * length(word)) + 1)::INT, 1)
                  ELSE substring('{synth.LETTERS}', (floor(u_letter * 26) + 1)::INT, 1) END AS letter
      FROM d JOIN wl USING (word_idx)),
y AS (SELECT *, length(word) - length(replace(word, letter, '')) AS count,
             {_sql_list(synth.USER_MSG_TEMPLATES)}[(floor(u_t * {len(synth.USER_MSG_TEMPLATES)}) + 1)::INT] AS t0,
             {_sql_list(synth.QUOTE_OPTIONS)}[(floor(u_lq * 3) + 1)::INT] AS lq,
             {_sql_list(synth.QUOTE_OPTIONS)}[(floor(u_wq * 3) + 1)::INT] AS wq FROM x),
z AS (SELECT *, replace(replace(CASE WHEN u_low < 0.3 THEN lower(t0) ELSE t0 END, '{{letter}}', lq || letter || lq),
                        '{{word}}', wq || word || wq) AS m0 FROM y)
SELECT idx, word, letter, count,
       CASE WHEN u_q < 0.5 THEN m0 || '?' ELSE m0 END AS user_msg,
       'We are asked to find the number ''' || letter || ''' in the word ''' || word || '''. Let me try a manual approach first.'
         || chr(10) || chr(10) || 'First spell the word out:' || chr(10) || word || ':' || array_to_string(string_split(word, ''), ',')
         || chr(10) || chr(10) || 'Then count the occurrences of ''' || letter || ''':' || chr(10)
         || array_to_string(list_transform(range(1, length(word) + 1), lambda i:
              CASE WHEN substring(word, i, 1) = letter
                   THEN i || ':' || substring(word, i, 1) || ' hit! count=' || (i - length(replace(substring(word, 1, i), letter, ''))) || chr(10)
                   ELSE i || ':' || substring(word, i, 1) || chr(10) END), '')
         || chr(10) || 'This gives us ' || count || '.' AS manual_text,
       '''' || word || '''.count(''' || letter || ''')' AS python_expr,
       count::VARCHAR AS python_output,
       chr(10) || chr(10) || 'Python gives us ' || count || '.' || chr(10) || chr(10) || 'My final answer is:' || chr(10) || chr(10) || '#### ' || count AS final_text
FROM z
"""


@register("spelling_bee", _SB_SQL)
def spelling_bee_q(spark, sf):
    idx = _t(spark, sf, "documents").select(F.col("doc_id").alias("idx"))
    return synth.spelling_bee(idx, _words(spark, sf))


@register("simple_spelling", "WITH " + _WORDS_SQL + f""",
sh AS (SELECT word, row_number() OVER (ORDER BY md5('42:' || word_idx)) - 1 AS sh_idx FROM wl),
d AS (SELECT doc_id AS idx, floor({_u('ss-word', 'doc_id + 10000000')} * (SELECT n FROM nw))::BIGINT AS sh_idx FROM documents)
SELECT idx, word, 'Spell the word: ' || word AS user_msg, word || ':' || array_to_string(string_split(word, ''), ',') AS assistant_msg
FROM d JOIN sh USING (sh_idx)
""")
def simple_spelling_q(spark, sf):
    idx = _t(spark, sf, "documents").select(F.col("doc_id").alias("idx"))
    return synth.simple_spelling(idx, _words(spark, sf), split="test")


# ---------------------------------------------------------------------------
# Prompt rendering (ICL items from the benchmark table; few-shot via F2)

from quill.operators import prompts  # noqa: E402


def _bench(spark, sf):
    return _t(spark, sf, "benchmark").select(F.col("item_id").alias("idx"), "text")


def _mc_items(spark, sf):
    b = _bench(spark, sf)
    q = F.floor(F.length("text") / 4).cast("int") + 1
    return b.select("idx", F.col("text").alias("query"),
                    F.array(*[F.substr("text", q * i + 1, q) for i in range(4)]).alias("choices"),
                    (F.col("idx") % 4).cast("int").alias("gold"))


def _shots(spark, sf):
    return evals.fewshot_examples(_bench(spark, sf).select("idx"), 2, seed=1234, key="idx")


_SHOTS_SQL = f"""
p AS (SELECT item_id AS idx, row_number() OVER (ORDER BY item_id) - 1 AS pos, count(*) OVER () AS n FROM benchmark),
t AS (SELECT idx, pos, n, list_transform(range(2), lambda i: floor(('0x' || substring(md5('1234:' || idx || ':' || i), 1, 8))::UBIGINT::DOUBLE
      / 4294967296.0 * (n - 3 + i + 1))::BIGINT) AS t FROM p),
s AS (SELECT idx, pos, [t[1], CASE WHEN t[2] = t[1] THEN n - 2 ELSE t[2] END] AS r FROM t),
shots AS (SELECT s.idx, j, p.idx AS shot_idx FROM s, range(2) k(j) JOIN p ON s.r[j + 1] + (s.r[j + 1] >= s.pos)::BIGINT = p.pos)
"""


@register("render_mc", """
SELECT item_id AS idx, 'Multiple Choice question: ' || text || chr(10)
       || '- ' || substring(text, 1, q) || '=A' || chr(10) || '- ' || substring(text, q + 1, q) || '=B' || chr(10)
       || '- ' || substring(text, 2 * q + 1, q) || '=C' || chr(10) || '- ' || substring(text, 3 * q + 1, q) || '=D' || chr(10)
       || chr(10) || 'Respond only with the letter of the correct answer.' AS prompt
FROM (SELECT *, length(text) // 4 + 1 AS q FROM benchmark)
""")
def render_mc_q(spark, sf):
    it = _mc_items(spark, sf)
    return it.select("idx", prompts.render_mc(F.col("query"), F.array(*[F.lit(c) for c in "ABCD"]),
                                              F.col("choices")).alias("prompt"))


@register("render_fewshot_mc", "WITH " + _SHOTS_SQL + """,
it AS (SELECT item_id AS idx, text AS query,
              [substring(text, 1, q), substring(text, q + 1, q), substring(text, 2 * q + 1, q), substring(text, 3 * q + 1, q)] AS choices,
              (item_id % 4)::INT AS gold FROM (SELECT *, length(text) // 4 + 1 AS q FROM benchmark)),
few AS (SELECT shots.idx, string_agg(it.query || ' ' || it.choices[it.gold + 1] || chr(10) || chr(10), '' ORDER BY j) AS fewshot
        FROM shots JOIN it ON shots.shot_idx = it.idx GROUP BY shots.idx)
SELECT it.idx, c.i - 1 AS choice_idx, coalesce(fewshot, '') || query || ' ' || it.choices[c.i] AS prompt
FROM it LEFT JOIN few USING (idx), range(1, 5) c(i)
""")
def render_fewshot_mc_q(spark, sf):
    return prompts.render_fewshot_mc(_mc_items(spark, sf), _shots(spark, sf))


@register("render_fewshot_schema", "WITH " + _SHOTS_SQL + """,
it AS (SELECT item_id AS idx, [substring(text, 1, q), substring(text, q + 1, q)] AS context_options,
              text AS continuation, (item_id % 2)::INT AS gold FROM (SELECT *, length(text) // 2 + 1 AS q FROM benchmark)),
few AS (SELECT shots.idx, string_agg(it.context_options[it.gold + 1] || ' ' || it.continuation || chr(10) || chr(10), '' ORDER BY j) AS fewshot
        FROM shots JOIN it ON shots.shot_idx = it.idx GROUP BY shots.idx)
SELECT it.idx, c.i - 1 AS option_idx, coalesce(fewshot, '') || it.context_options[c.i] || ' ' || continuation AS prompt
FROM it LEFT JOIN few USING (idx), range(1, 3) c(i)
""")
def render_fewshot_schema_q(spark, sf):
    b = _bench(spark, sf)
    q = F.floor(F.length("text") / 2).cast("int") + 1
    it = b.select("idx", F.array(F.substr("text", F.lit(1), q), F.substr("text", q + 1, q)).alias("context_options"),
                  F.col("text").alias("continuation"), (F.col("idx") % 2).cast("int").alias("gold"))
    return prompts.render_fewshot_schema(it, _shots(spark, sf))


_TRIM = r"regexp_replace({x}, '^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$', '', 'g')"


@register("render_fewshot_lm", "WITH " + _SHOTS_SQL + f""",
it AS (SELECT item_id AS idx, ' ' || text || '  ' AS context, reverse(text) AS continuation FROM benchmark),
few AS (SELECT shots.idx, string_agg({_TRIM.format(x='it.context')} || ' ' || it.continuation || chr(10) || chr(10), '' ORDER BY j) AS fewshot
        FROM shots JOIN it ON shots.shot_idx = it.idx GROUP BY shots.idx)
SELECT idx, {_TRIM.format(x="coalesce(fewshot, '') || " + _TRIM.format(x='context') + " || ' '")} AS prompt_without,
       coalesce(fewshot, '') || {_TRIM.format(x='context')} || ' ' || continuation AS prompt_with
FROM it LEFT JOIN few USING (idx)
""")
def render_fewshot_lm_q(spark, sf):
    b = _bench(spark, sf)
    it = b.select("idx", F.concat(F.lit(" "), F.col("text"), F.lit("  ")).alias("context"),
                  F.reverse("text").alias("continuation"))
    return prompts.render_fewshot_lm(it, _shots(spark, sf))


@register("build_prompt_batch", """
WITH st AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS starter_idx, text FROM benchmark),
n AS (SELECT count(*) AS n FROM st),
pk AS (SELECT doc_id AS idx, j, floor(('0x' || substring(md5('starter:' || doc_id || ':' || j), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 * (SELECT n FROM n))::BIGINT AS starter_idx
       FROM documents, range(5) r(j))
SELECT idx, replace('Write a conversation. Inspiration:' || chr(10) || '%USER_FIRST_PROMPTS%' || chr(10) || 'End.',
                    '%USER_FIRST_PROMPTS%', string_agg(text, chr(10) ORDER BY j)) AS prompt
FROM pk JOIN st USING (starter_idx) GROUP BY idx
""")
def build_prompt_batch_q(spark, sf):
    st = corpus.with_index(_t(spark, sf, "benchmark").select("item_id", "text"),
                           ["item_id"], out="starter_idx")
    idx = _t(spark, sf, "documents").select(F.col("doc_id").alias("idx"))
    return prompts.build_prompt_batch(idx, st.select("starter_idx", "text"),
                                      "Write a conversation. Inspiration:\n%USER_FIRST_PROMPTS%\nEnd.")


def _tool_answers(spark, sf):
    """GSM-style answers: text, a calculator call (some with wrong results), a final answer."""
    c = _t(spark, sf, "conversations").where(F.col("role") == "assistant")
    n = F.length("text")
    res = F.when(F.col("turn") % 4 == 1, n * 2 + 1).otherwise(n * 2)
    ans = F.concat(F.col("text"), F.lit(" <<"), n.cast("string"), F.lit("*2="), res.cast("string"),
                   F.lit(">> then <<"), F.lit("'"), F.col("text"), F.lit("'.count('e')"),
                   F.lit(">>.\n#### "), res.cast("string"))
    return c.select("conv_id", "turn", ans.alias("answer"))


@register("parse_tool_calls")
def parse_tool_calls_q(spark, sf):
    a = _tool_answers(spark, sf)
    p = a.select("conv_id", "turn", prompts.parse_tool_calls(F.col("answer")).alias("parts"))
    return p.select("conv_id", "turn", F.size("parts").alias("n_parts"),
                    F.array_join(F.transform("parts", lambda x: x["type"]), ",").alias("types"))


@register("audit_tool_results")
def audit_tool_results_q(spark, sf):
    a = _tool_answers(spark, sf)
    p = a.select("conv_id", "turn", prompts.parse_tool_calls(F.col("answer")).alias("parts"))
    return prompts.audit_tool_results(p, ["conv_id", "turn"])


@register("assemble_program")
def assemble_program_q(spark, sf):
    c = _t(spark, sf, "conversations")
    prompt = F.concat(F.lit("import os\nfrom math import sqrt\n# helper\n\ndef f():\n    import sys\n"),
                      F.lit('    """'), F.col("text"), F.lit('"""'))
    completion = F.concat(F.lit("Sure:\n```python\ndef f():\n    return "), F.length("text").cast("string"),
                          F.lit("\n```\n"))
    prog = prompts.assemble_program(prompt, completion, F.lit("def check(fn):\n    assert fn() > 0"), F.lit("f"))
    return c.select("conv_id", "turn", prog.alias("program"))


@register("parse_structured_reply", """
SELECT valid, count(*) AS n FROM (
  SELECT conv_id, conv_id % 7 <> 0 AND bool_and(role = CASE WHEN pos % 2 = 1 THEN 'user' ELSE 'assistant' END) AS valid
  FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations) GROUP BY conv_id) GROUP BY valid
""")
def parse_structured_reply_q(spark, sf):
    c = _t(spark, sf, "conversations")
    msgs = (c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
            .select("conv_id", F.to_json(F.struct(F.transform("m", lambda x: F.struct(
                x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))).alias("content")))
    broken = F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit("Sure: "), F.col("content"))).otherwise(F.col("content"))
    r = prompts.parse_structured_reply(msgs.select("conv_id", broken.alias("content")))
    return r.groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


@register("render_conversation")
def render_conversation_q(spark, sf):
    r = chat.render_conversation(_t(spark, sf, "conversations"), trained_merges(spark, sf), max_tokens=2048)
    return r.select("conv_id", F.size("ids").alias("n_tokens"), chat.supervised_tokens(r).alias("supervised"),
                    F.md5(F.array_join("ids", ",")).alias("ids_md5"))


@register("supervised_tokens")
def supervised_tokens_q(spark, sf):
    r = chat.render_conversation(_t(spark, sf, "conversations"), trained_merges(spark, sf), max_tokens=2048)
    return r.agg(F.count(F.lit(1)).alias("conversations"), F.sum(chat.supervised_tokens(r)).alias("supervised"))


@register("pack_conversations")
def pack_conversations_q(spark, sf):
    r = chat.render_conversation(_t(spark, sf, "conversations"), trained_merges(spark, sf))
    r = corpus.with_index(r, ["conv_id"])
    p = pack.pack_conversations(r, 2, 128, rank=0, world=2)
    return p.select("block", "row", F.md5(F.array_join("inputs", ",")).alias("inputs_md5"), "progress")


_MID_TRAIN = {"smoltalk": ("documents", "doc_id"), "mmlu-auxiliary": ("pages", "page_id"), "gsm8k": ("conversations", "conv_id"),
              "identity": ("benchmark", "item_id"), "simple-spelling": ("lineitem", "l_orderkey"), "spelling-bee": ("orders", "o_orderkey")}


@register("recipe_mixture")
def recipe_q(spark, sf):
    """The mid-training recipe over whole tables as its sources (one of them listed twice)."""
    sources = {name: corpus.with_index(_t(spark, sf, table).select(key).distinct(), [key], out="local_idx") for name, (table, key) in _MID_TRAIN.items()}
    return chat.named_recipe("mid-train", sources).select("task_idx", "copy", "local_idx", "idx")


# ---------------------------------------------------------------------------
# Shard assignment (sinks) and buffered shuffle: greedy segmentation checked
# against a recursive CTE

from quill.sources import sinks  # noqa: E402


def _greedy_sql(items: str, order: str, weight: str, t: int) -> str:
    return f"""
gi AS (SELECT {order} AS o, {weight} AS w, row_number() OVER (ORDER BY {order}) - 1 AS i FROM {items}),
rec(i, acc, seg) AS (
  SELECT i, w, 0 FROM gi WHERE i = 0
  UNION ALL
  SELECT gi.i, CASE WHEN rec.acc >= {t} THEN gi.w ELSE rec.acc + gi.w END,
         CASE WHEN rec.acc >= {t} THEN rec.seg + 1 ELSE rec.seg END
  FROM rec JOIN gi ON gi.i = rec.i + 1),
segs AS (SELECT gi.o, rec.seg, rec.seg = (SELECT count(*) FROM rec WHERE acc >= {t}) AS is_tail
         FROM rec JOIN gi USING (i))
"""


@register("shard_by_chars", "WITH RECURSIVE d AS (SELECT doc_id, length(text) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS g FROM documents),"
          + " grp AS (SELECT g, sum(n) AS chars FROM d GROUP BY g)," + _greedy_sql("grp", "g", "chars", 40000) + """
SELECT doc_id, seg AS shard, is_tail FROM d JOIN segs ON d.g = segs.o
""")
def shard_by_chars_q(spark, sf):
    path = _folder(spark, "by-chars")
    sinks.write_shards_by_chars(_t(spark, sf, "documents"), path, "doc_id", budget=40000, group=8, keep=("doc_id", "is_tail"))
    return _read_shards(spark, path, "doc_id", "is_tail")


def _read_shards(spark, path, *columns):
    """Rows of written shards with the number in their file's name."""
    number = F.regexp_extract("shard", r"^shard_([0-9]+)\.parquet$", 1).cast("long")
    return files.read_corpus(spark, path, columns).withColumn("shard", number).select(*columns, "shard")


@register("shard_by_rows", """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS shard FROM documents
""")
def shard_by_rows_q(spark, sf):
    path = _folder(spark, "by-rows")
    sinks.write_shards_by_rows(_t(spark, sf, "documents"), path, "doc_id", rows=64, keep=("doc_id",))
    return _read_shards(spark, path, "doc_id")


@register("shard_qa_pairs", r"""
WITH RECURSIVE s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
             lambda p: regexp_replace(p, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')),
             lambda p: p <> '') AS paras FROM documents),
u AS (SELECT doc_id, paras, unnest(range(len(paras))) AS pos FROM s),
m AS (SELECT doc_id, pos FROM u WHERE pos > 0 AND regexp_matches(paras[pos + 1], '^(?i:e\pL*)[\t\n\x0B\f\r ]*,')),
pd AS (SELECT doc_id, count(*) AS n FROM m GROUP BY doc_id),
""" + _greedy_sql("pd", "doc_id", "n", 5) + """
SELECT m.doc_id, m.pos, seg AS shard, is_tail FROM m JOIN segs ON m.doc_id = segs.o
""")
def shard_qa_pairs_q(spark, sf):
    pairs = corpus.extract_qa_pairs(_t(spark, sf, "documents"), _QA_SPEAKER, sep=r"\n")
    path = _folder(spark, "qa")
    pairs = pairs.withColumn("doc", F.col("doc_id"))
    sinks.write_qa_shards(pairs, path, doc="doc", rows=5, keep=("doc_id", "pos", "is_tail"))
    return _read_shards(spark, path, "doc_id", "pos", "is_tail")


@register("shuffle_buffered", r"""
WITH RECURSIVE s AS (SELECT doc_id, text, string_split(text, '.') AS parts FROM documents),
e AS (SELECT doc_id, text, len(parts) AS n, unnest(range(len(parts))) AS pos, parts FROM s),
f AS (SELECT doc_id, pos, regexp_replace(parts[pos + 1], '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g') AS s FROM e),
sent AS (SELECT doc_id, pos FROM f WHERE s <> ''),
pd AS (SELECT doc_id, count(*) AS n FROM sent GROUP BY doc_id),
""" + _greedy_sql("pd", "doc_id", "n", 2000) + """,
r AS (SELECT sent.doc_id, sent.pos, seg AS buffer,
             row_number() OVER (ORDER BY seg, md5('42:' || sent.doc_id || ':' || sent.pos)) - 1 AS rank
      FROM sent JOIN segs ON sent.doc_id = segs.o)
SELECT doc_id, pos, buffer, rank FROM r WHERE rank < 20000
""")
def shuffle_buffered_q(spark, sf):
    s = corpus.sentences(_t(spark, sf, "documents"))
    b = corpus.shuffle_buffered(s, n=2000, seed=42, max_sentences=20000)
    return b.select("doc_id", "pos", F.col("buffer").cast("long").alias("buffer"), "rank")


# ---------------------------------------------------------------------------
# Streaming: the corpus stream (A4) feeding the stateful packer (E3), run to
# completion with an available-now trigger into the cluster's shared folder.

import uuid  # noqa: E402

from quill.plans.order import dense_index  # noqa: E402
from quill.session import discard, ensure_checkpoint_dir, scratch  # noqa: E402
from quill.sources.corpus_stream import stream_epochs  # noqa: E402
from quill.sources.shard_writer import write_shards  # noqa: E402
from quill.streaming import stream  # noqa: E402


_RANKS = 4


@register("pack_stream")
def pack_stream_q(spark, sf):
    """Four ranks; the source files hold documents in any order and arrive one by one."""
    base = _folder(spark, "stream")
    docs = _t(spark, sf, "documents").select("doc_id", "text").withColumn("rank", F.pmod("doc_id", F.lit(_RANKS)).cast("int"))
    with scratch(spark):        # texts are numbered, a fraction of the size of their ids
        (dense_index(docs, ["doc_id"], out="seq", partition_by=["rank"]).select("doc_id", _cps().alias("ids"), "rank", "seq")
         .write.option("compression", "zstd").parquet(base + "/src"))
    schema = spark.read.parquet(base + "/src").schema
    s = stream.stream_corpus(spark, base + "/src", schema, files_per_batch=2, columns=("rank", "seq", "ids"), delete_read=True)
    with stream.stateful(spark, _RANKS):
        q = (stream.pack_stream(s, _B, _T).writeStream.format("parquet").option("compression", "zstd").option("path", base + "/out")
             .option("checkpointLocation", base + "/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    discard(spark, base + "/src", base + "/ckpt")       # all of it is in the blocks
    out = spark.read.parquet(base + "/out")
    return out.select("rank", "block", "row", F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
                      F.md5(F.array_join("targets", ",")).alias("targets_md5"))


@register("stream_epochs", f"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
g AS (SELECT doc_id, pos, pos // 64 AS shard, pos % 64 // 8 AS row_group, pos % 64 // 8 % {_RANKS} AS rank FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY pos) - 1 AS n, count(*) OVER (PARTITION BY rank) AS many FROM g)
SELECT epoch, printf('shard_%05d.parquet', shard) AS shard, row_group, rank, n + epoch * many AS seq, doc_id FROM r, range(2) e(epoch)
""")
def stream_epochs_q(spark, sf):
    """Two epochs of the documents as a sharded corpus, with a stop and a restart between them."""
    base = _folder(spark, "epochs")
    docs = sinks.shard_by_rows(_t(spark, sf, "documents"), "doc_id", rows=64)
    write_shards(docs.select("__pos", "doc_id", "shard"), base + "/corpus", ["__pos"], row_group_rows=8)
    for epochs in (1, 2):
        s = stream_epochs(spark, base + "/corpus", base + "/progress", "doc_id bigint", ranks=_RANKS, groups=100, epochs=epochs, grow=2)
        q = (s.writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/ckpt").start())
        q.processAllAvailable()
        q.stop()
    return spark.read.parquet(base + "/out").select("epoch", "shard", "row_group", "rank", "seq", "doc_id")


@register("nfkc_docs")
def nfkc_q(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    n = d.select("doc_id", tx.nfkc("text").alias("norm"), "text")
    return n.select("doc_id", (F.col("norm") != F.col("text")).alias("changed"), F.length("norm").alias("n_chars"))


@register("wall_clock", """
WITH s AS (SELECT user_id % 4 AS run, event_type AS section, event_id AS section_no, ts FROM events),
st AS (SELECT run, min(ts) AS start_ts FROM s GROUP BY run),
e AS (SELECT run, arg_max(ts, section_no) AS end_ts FROM s WHERE NOT contains(section, 'rl') GROUP BY run),
x AS (SELECT run, floor(epoch(end_ts) - epoch(start_ts))::BIGINT AS seconds FROM e JOIN st USING (run))
SELECT run, seconds, seconds // 3600 AS hours, (seconds % 3600) // 60 AS minutes FROM x
""")
def wall_clock_q(spark, sf):
    e = _t(spark, sf, "events")
    s = e.select((F.col("user_id") % 4).alias("run"), F.col("event_type").alias("section"),
                 F.col("event_id").alias("section_no"), "ts")
    st = s.groupBy("run").agg(F.min("ts").alias("start_ts"))
    w = evals.wall_clock(s.join(st, "run"))
    return w.select("run", "seconds", F.col("hours").cast("long").alias("hours"),
                    F.col("minutes").cast("long").alias("minutes"))


@register("roundtrip_check")
def roundtrip_check_q(spark, sf):
    m = trained_merges(spark, sf)
    return bpe.roundtrip_check(_t(spark, sf, "documents").select("text"), m, _vocab(spark, sf),
                               letters=["A", "B", "C", "D"])


@register("render_spelling_bee")
def render_spelling_bee_q(spark, sf):
    """Spelling-bee conversations (user string + assistant parts) rendered to ids/mask."""
    idx = _t(spark, sf, "documents").select(F.col("doc_id").alias("idx"))
    sb = synth.spelling_bee(idx, _words(spark, sf))
    part = lambda t, c: F.struct(F.lit(t).alias("type"), c.alias("text"))
    parts = F.array(part("text", F.col("manual_text")),
                    part("text", F.lit("\n\nLet me double check this using Python:\n\n")),
                    part("python", F.col("python_expr")), part("python_output", F.col("python_output")),
                    part("text", F.col("final_text")))
    conv = sb.select(F.col("idx").alias("conv_id"), F.col("user_msg").alias("user"), parts.alias("assistant_parts"))
    segs = chat.render_part_segments(conv)
    r = chat.render_conversation(None, trained_merges(spark, sf), segments=segs)
    return r.select("conv_id", F.size("ids").alias("n_tokens"), chat.supervised_tokens(r).alias("supervised"),
                    F.md5(F.array_join("ids", ",")).alias("ids_md5"))


# oracles for queries registered above whose SQL reuses earlier pieces
_L = _B * _T + 1
ORACLE["pack_stream"] = f"""
WITH cp AS (SELECT doc_id, 0 AS p, 0 AS tok FROM documents
            UNION ALL SELECT doc_id, i, unicode(substring(text, i, 1)) FROM documents, range(1, length(text) + 1) r(i)),
st AS (SELECT doc_id % {_RANKS} AS rank, row_number() OVER (PARTITION BY doc_id % {_RANKS} ORDER BY doc_id, p) - 1 AS g, tok FROM cp),
b AS (SELECT rank, g // {_L} AS block, list(tok ORDER BY g) AS toks FROM st GROUP BY 1, 2 HAVING count(*) = {_L})
SELECT rank, block, r AS "row", md5(array_to_string(toks[r * {_T} + 1:r * {_T} + {_T}], ',')) AS inputs_md5,
       md5(array_to_string(toks[r * {_T} + 2:r * {_T} + {_T} + 1], ',')) AS targets_md5
FROM b, range({_B}) t(r)"""
ORACLE["recipe_mixture"] = "WITH u AS (" + " UNION ALL ".join(
    f"SELECT {i} AS task_idx, {copy} AS copy, local_idx FROM (SELECT row_number() OVER (ORDER BY {_MID_TRAIN[s][1]}) - 1 AS local_idx "
    f"FROM (SELECT DISTINCT {_MID_TRAIN[s][1]} FROM {_MID_TRAIN[s][0]}))" + ("" if stop is None else f" WHERE local_idx < {stop}")
    for i, (s, stop, copy) in enumerate([("smoltalk", None, 0), ("mmlu-auxiliary", None, 0), ("gsm8k", None, 0), ("identity", None, 0), ("identity", None, 1),
                                         ("simple-spelling", 200_000, 0), ("spelling-bee", 80_000, 0)])) + """)
SELECT task_idx, copy, local_idx, row_number() OVER (ORDER BY md5('42:' || task_idx || ':' || copy || ':' || local_idx)) - 1 AS idx
FROM u
"""
ORACLE["parse_tool_calls"] = r"""
WITH a AS (SELECT conv_id, turn,
                  text || ' <<' || length(text) || '*2=' || (CASE WHEN turn % 4 = 1 THEN length(text) * 2 + 1 ELSE length(text) * 2 END)
                  || '>> then <<''' || text || '''.count(''e'')>>.' || chr(10) || '#### '
                  || (CASE WHEN turn % 4 = 1 THEN length(text) * 2 + 1 ELSE length(text) * 2 END) AS answer
           FROM conversations WHERE role = 'assistant'),
p AS (SELECT conv_id, turn, string_split(regexp_replace(answer, '(<<[^>]+>>)', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS pieces FROM a)
SELECT conv_id, turn,
       list_sum(list_transform(pieces, lambda x: CASE WHEN starts_with(x, '<<') AND ends_with(x, '>>') THEN 2 ELSE 1 END)) AS n_parts,
       array_to_string(list_transform(pieces, lambda x: CASE WHEN starts_with(x, '<<') AND ends_with(x, '>>') THEN 'python,python_output' ELSE 'text' END), ',') AS types
FROM p
"""


# ---------------------------------------------------------------------------
# Type normalization for the comparison: Spark integer columns are widened to
# bigint (see ``__spark_entry__``), and DuckDB's wider or decimal result
# types (sums → HUGEINT, decimal literals, recursive-CTE INTEGER) are cast
# back to BIGINT / DOUBLE. Values are unchanged.
ORACLE_CASTS: dict[str, dict[str, str]] = {
    "audit_request_limits": {"total_len": "BIGINT"},
    "centered_score": {"baseline": "DOUBLE"},
    "char_budget": {"chars_before": "BIGINT"},
    "chunk_stats_by_lang": {"n_chunks": "BIGINT"},
    "masked_token_mean": {"active_tokens": "BIGINT"},
    "match_speaker": {"n_speaker": "BIGINT", "n_comma": "BIGINT", "n_question": "BIGINT"},
    "pack_blocks": {"inputs_sum": "BIGINT"},
    "pack_stream": {"rank": "BIGINT", "block": "BIGINT", "row": "BIGINT"},
    "pair_counts": {"cnt": "BIGINT"},
    "parse_tool_calls": {"n_parts": "BIGINT"},
    "policy_objective": {"n_valid": "BIGINT"},
    "pretokenize_docs": {"chunk_chars": "BIGINT"},
    "read_corpus_shards": {"n_chars": "BIGINT"},
    "sequence_tasks": {"idx": "BIGINT"},
    "shard_by_chars": {"shard": "BIGINT"},
    "shard_qa_pairs": {"shard": "BIGINT"},
    "shuffle_buffered": {"buffer": "BIGINT"},
    "token_offsets": {"offset": "BIGINT"},
    "group_advantage": {"sample_no": "BIGINT"},
    "mix_tasks": {"task_idx": "BIGINT", "copy": "BIGINT"},
    "recipe_mixture": {"task_idx": "BIGINT", "copy": "BIGINT"},
    "option_spans_mc": {"option": "BIGINT", "start": "BIGINT", "end": "BIGINT"},
    "option_spans_schema": {"option": "BIGINT", "start": "BIGINT", "end": "BIGINT"},
    "render_segments": {"mask": "BIGINT"},
    "render_completion_segments": {"mask": "BIGINT"},
    "report_summary": {"sort_key": "BIGINT"},
    "score_options": {"pred": "BIGINT", "gold": "BIGINT"},
}
ORACLE_CASTS["pair_counts"].update({"left": "BIGINT", "right": "BIGINT"})
ORACLE_CASTS["sequence_tasks"].update({"task_idx": "BIGINT"})


def normalized_oracle(name: str) -> str:
    sql = ORACLE[name]
    casts = ORACLE_CASTS.get(name)
    if not casts:
        return sql
    rep = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in casts.items())
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS oracle_q"


_STRIP = r"regexp_replace({x}, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')"
ORACLE["assemble_program"] = r"""
WITH p AS (SELECT conv_id, turn,
                  'import os' || chr(10) || 'from math import sqrt' || chr(10) || '# helper' || chr(10) || chr(10)
                  || 'def f():' || chr(10) || '    import sys' || chr(10) || '    """' || text || '"""' AS prompt,
                  'Sure:' || chr(10) || '```python' || chr(10) || 'def f():' || chr(10) || '    return ' || length(text)
                  || chr(10) || '```' || chr(10) AS completion
           FROM conversations),
l AS (SELECT conv_id, turn, completion,
             list_transform(string_split(prompt, chr(10)), lambda x: """ + _STRIP.format(x="x") + r""") AS lines FROM p),
s AS (SELECT conv_id, turn, completion, lines,
             list_position(list_transform(lines, lambda x: NOT (starts_with(x, 'import ') OR starts_with(x, 'from '))
                                                  AND x <> '' AND NOT starts_with(x, '#')), true) AS stop FROM l),
i AS (SELECT conv_id, turn, completion,
             array_to_string(list_filter(CASE WHEN stop IS NULL THEN lines ELSE lines[1:stop - 1] END,
                                         lambda x: starts_with(x, 'import ') OR starts_with(x, 'from ')), chr(10)) AS imports
      FROM s)
SELECT conv_id, turn,
       imports || chr(10) || chr(10)
       || CASE WHEN regexp_matches(completion, '(?s)```(?:python)?\s*\n(.*?)\n```')
               THEN """ + _STRIP.format(x=r"regexp_extract(completion, '(?s)```(?:python)?\s*\n(.*?)\n```', 1)") + r"""
               ELSE """ + _STRIP.format(x="completion") + r""" END
       || chr(10) || chr(10) || 'def check(fn):' || chr(10) || '    assert fn() > 0' || chr(10) || 'check(f)' AS program
FROM i
"""
ORACLE["roundtrip_check"] = "SELECT 0::BIGINT AS roundtrip_mismatches, 0::BIGINT AS multi_token_letters"


# ---------------------------------------------------------------------------
# Tokenizer oracles: training unrolled into one pair of CTEs per merge over the
# distinct chunks, then everything else on the final token strings. The SQL knows
# nothing of batches, heaps or caches: each step takes the single best pair.


def _train_sql(n: int) -> str:
    steps = [f"""w0 AS MATERIALIZED (
  SELECT c, cnt, '<' || array_to_string(list_transform(regexp_extract_all(hex(encode(c)), '..'), lambda x: ('0x' || x)::INT), '><') || '>' AS tok
  FROM (SELECT c, sum(n)::BIGINT AS cnt FROM (
          SELECT unnest(regexp_extract_all(text, '{_RE2}', 1)) AS c, 1 AS n FROM documents
          UNION ALL SELECT unnest(regexp_extract_all(value, '{_RE2}', 1)), 0 FROM ({ORACLE["render_segments"]}) WHERE kind = 'text') GROUP BY c))"""]
    for i in range(n):
        steps.append(f"""b{i} AS MATERIALIZED (
  SELECT p[1]::INT AS l, p[2]::INT AS r, sum(cnt)::BIGINT AS n
  FROM (SELECT cnt, unnest(list_zip(t[:-2], t[2:])) AS p FROM (SELECT cnt, regexp_extract_all(tok, '<([0-9]+)>', 1) AS t FROM w{i} WHERE contains(tok, '><')))
  GROUP BY ALL ORDER BY n DESC, l, r LIMIT 1)""")
        steps.append(f"""w{i + 1} AS MATERIALIZED (
  SELECT c, cnt, coalesce(replace(tok, '<' || l || '><' || r || '>', '<{256 + i}>'), tok) AS tok FROM w{i} LEFT JOIN b{i} ON true)""")
    steps.append("merges AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {i} AS rank, l, r, {256 + i} AS id, n FROM b{i}" for i in range(n)) + ")")
    steps.append(f"""parts(id, path, sym) AS (
  SELECT id, '', id FROM (SELECT unnest(range(256)) AS id UNION ALL SELECT id FROM merges)
  UNION ALL SELECT p.id, path || side, CASE side WHEN '0' THEN m.l ELSE m.r END FROM parts p JOIN merges m ON p.sym = m.id, (VALUES ('0'), ('1')) s(side)),
ranks AS MATERIALIZED (SELECT id, string_agg(printf('%02X', sym), '' ORDER BY path) AS token_hex FROM parts WHERE sym < 256 GROUP BY id),
final AS MATERIALIZED (SELECT c, cnt, tok, len(regexp_extract_all(tok, '<')) AS n_tok FROM w{n}),
specials AS (SELECT {256 + n} + i - 1 AS id, '{{}}' AS token_hex, s AS special FROM (SELECT unnest({_sql_list(tx.SPECIAL_TOKENS)}) AS s, unnest(range(1, {len(tx.SPECIAL_TOKENS) + 1})) AS i))""")
    return "WITH RECURSIVE " + ",\n".join(steps) + "\n"


_TRAIN_SQL = _train_sql(_VOCAB - 256 - len(tx.SPECIAL_TOKENS))
# bytes of a token decoded with replacement characters: valid sequences keep their
# length, each truncated or stray part becomes three bytes
_VALID = r"([0-7][0-9A-F],|(C[2-9A-F]|D[0-9A-F]),[89AB][0-9A-F],|E0,[AB][0-9A-F],[89AB][0-9A-F],|(E[1-9A-C]|E[EF]),([89AB][0-9A-F],){2}|ED,[89][0-9A-F],[89AB][0-9A-F],|F0,[9AB][0-9A-F],([89AB][0-9A-F],){2}|F[1-3],([89AB][0-9A-F],){3}|F4,8[0-9A-F],([89AB][0-9A-F],){2})"
_STRAY = r"(E0,[AB][0-9A-F],|(E[1-9A-C]|E[EF]),[89AB][0-9A-F],|ED,[89][0-9A-F],|F0,[9AB][0-9A-F],([89AB][0-9A-F],)?|F[1-3],([89AB][0-9A-F],){1,2}|F4,8[0-9A-F],([89AB][0-9A-F],)?|[0-9A-F]{2},)"
_LENGTHS_SQL = f"""lengths AS (
  SELECT id AS token_id, (length(h) - length(bad)) // 3 + 3 * len(regexp_extract_all(bad, '{_STRAY}')) AS n_bytes
  FROM (SELECT id, h, array_to_string(list_transform(regexp_split_to_array(h, '{_VALID}'), lambda x: x), '') AS bad
        FROM (SELECT id, regexp_replace(token_hex, '(..)', '\\1,', 'g') AS h FROM ranks))
  UNION ALL SELECT id, 0 FROM specials)"""
_COUNT_SQL = "counted AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT sum(length(text)) FROM documents)::BIGINT AS chars, (SELECT sum(cnt * n_tok) FROM final)::BIGINT + (SELECT count(*) FROM documents) AS tokens)"
ORACLE["bpe_train"] = _TRAIN_SQL + 'SELECT rank, l AS "left", r AS "right", id AS new_id, n AS cnt FROM merges'
ORACLE["mergeable_ranks"] = _TRAIN_SQL + "SELECT id AS token_id, token_hex FROM ranks"
ORACLE["vocab_with_specials"] = _TRAIN_SQL + """SELECT id AS token_id, token_hex, NULL::VARCHAR AS special FROM ranks
UNION ALL SELECT id, hex(encode(special)), special FROM specials"""
ORACLE["encode_docs"] = _TRAIN_SQL + f"""SELECT doc_id, coalesce(sum(n_tok), 0)::BIGINT + 1 AS n_tokens,
  md5('{_VOCAB - 9}' || coalesce(',' || string_agg(replace(trim(tok, '<>'), '><', ','), ',' ORDER BY i), '')) AS ids_md5
FROM (SELECT doc_id, unnest(chunks) AS c, unnest(range(1, len(chunks) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{_RE2}', 1) AS chunks FROM documents))
JOIN final USING (c) GROUP BY doc_id UNION ALL SELECT doc_id, 1, md5('{_VOCAB - 9}') FROM documents WHERE coalesce(text, '') = ''"""
ORACLE["token_byte_lengths"] = _TRAIN_SQL.rstrip() + ",\n" + _LENGTHS_SQL + " SELECT token_id, n_bytes FROM lengths"
ORACLE["vocab_stats"] = _TRAIN_SQL.rstrip() + ",\n" + _LENGTHS_SQL + """ SELECT min(b) AS min_bytes, max(b) AS max_bytes, round(avg(b), 6) AS mean_bytes,
  round(stddev_samp(b), 6) AS std_bytes, count(*) FILTER (n_bytes = 0) AS num_special FROM (SELECT n_bytes, nullif(n_bytes, 0) AS b FROM lengths)"""
ORACLE["count_tokens"] = _TRAIN_SQL.rstrip() + ",\n" + _COUNT_SQL + """ SELECT docs, chars, tokens, round(chars / tokens, 6) AS chars_per_token,
  round(tokens / docs, 6) AS tokens_per_doc FROM counted"""
ORACLE["training_budget"] = _TRAIN_SQL.rstrip() + ",\n" + _COUNT_SQL + """ SELECT tokens, greatest(1, greatest(1, tokens - 1) // 524288)::BIGINT AS num_iterations,
  round(524288.0::DOUBLE * greatest(1, greatest(1, tokens - 1) // 524288) / 561000000, 6) AS tokens_per_param,
  ceil(20.0::DOUBLE * 561000000 * round(chars / tokens, 6) / 250000000)::BIGINT AS shards_needed FROM counted"""
ORACLE["compression_report"] = _TRAIN_SQL.rstrip() + f""",
per AS (SELECT lang, sum(strlen(c))::BIGINT AS by_byte, sum(n_tok)::BIGINT AS trained
        FROM (SELECT lang, unnest(regexp_extract_all(text, '{_RE2}', 1)) AS c FROM documents) JOIN final USING (c) GROUP BY lang),
b AS (SELECT lang, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY lang),
t AS (SELECT lang, 'bytes' AS tokenizer, by_byte AS tokens, by_byte AS base FROM per UNION ALL SELECT lang, 'trained', trained, by_byte FROM per),
r AS (SELECT t.*, bytes, round(bytes / tokens, 6) AS ratio FROM t JOIN b USING (lang))
SELECT lang, tokens, tokenizer, bytes, ratio, round((base - tokens) / base * 100, 6) AS relative_pct, ratio = max(ratio) OVER (PARTITION BY lang) AS is_best FROM r"""
for _name, _casts in {"bpe_train": {"rank": "BIGINT", "left": "BIGINT", "right": "BIGINT", "new_id": "BIGINT"}, "mergeable_ranks": {"token_id": "BIGINT"},
                      "vocab_with_specials": {"token_id": "BIGINT"}, "token_byte_lengths": {"token_id": "BIGINT", "n_bytes": "BIGINT"},
                      "vocab_stats": {"min_bytes": "BIGINT", "max_bytes": "BIGINT"}}.items():
    ORACLE_CASTS.setdefault(_name, {}).update(_casts)


def _rendered_sql(max_tokens: int) -> str:
    """Ids and masks of every conversation (``rendered``), after the training CTEs."""
    return _TRAIN_SQL.rstrip() + f""",
seg AS MATERIALIZED ({ORACLE["render_segments"]}),
pieces AS (
  SELECT conv_id, seg_no, 0 AS i, id::VARCHAR AS ids, 1 AS n, mask FROM seg JOIN specials ON value = special WHERE kind = 'special'
  UNION ALL SELECT conv_id, seg_no, i, replace(trim(tok, '<>'), '><', ','), n_tok, mask
  FROM (SELECT conv_id, seg_no, mask, unnest(chunks) AS c, unnest(range(1, len(chunks) + 1)) AS i
        FROM (SELECT *, regexp_extract_all(value, '{_RE2}', 1) AS chunks FROM seg WHERE kind = 'text')) JOIN final USING (c)),
rendered AS (SELECT conv_id, string_split(string_agg(ids, ',' ORDER BY seg_no, i), ',')[1:{max_tokens}] AS ids,
                    string_split(rtrim(string_agg(repeat(mask::VARCHAR || ',', n::INT), '' ORDER BY seg_no, i), ','), ',')[1:{max_tokens}] AS masks
             FROM pieces GROUP BY conv_id),
supervised AS (SELECT conv_id, ids, coalesce(list_sum(list_transform(masks[2:], lambda x: x::BIGINT)), 0)::BIGINT AS n FROM rendered)
"""


ORACLE["render_conversation"] = _rendered_sql(2048) + "SELECT conv_id, len(ids) AS n_tokens, n AS supervised, md5(array_to_string(ids, ',')) AS ids_md5 FROM supervised"
ORACLE["supervised_tokens"] = _rendered_sql(2048) + "SELECT count(*) AS conversations, sum(n)::BIGINT AS supervised FROM supervised"
# two streams of conversations, blocks of 2 * 128 + 1 tokens, the incomplete one dropped
ORACLE["pack_conversations"] = _rendered_sql(2048).rstrip() + """,
mine AS (SELECT conv_id, ids, sum(len(ids)) OVER (ORDER BY conv_id) AS stop
         FROM (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS idx FROM rendered) WHERE idx % 2 = 0),
stream AS (SELECT unnest(ids) AS tok, unnest(range(stop::BIGINT - len(ids), stop::BIGINT)) AS pos FROM mine),
blocks AS (SELECT pos // 257 AS block, list(tok ORDER BY pos) AS toks FROM stream GROUP BY 1 HAVING count(*) = 257)
SELECT block, r AS row, md5(array_to_string(toks[r * 128 + 1:r * 128 + 128], ',')) AS inputs_md5,
       round((SELECT count(*) FROM mine WHERE stop <= (block + 1) * 257) / (SELECT count(*) FROM mine), 6) AS progress
FROM blocks, range(2) t(r)"""
for _name, _casts in {"render_conversation": {"n_tokens": "BIGINT"}, "pack_conversations": {"block": "BIGINT", "row": "BIGINT"}}.items():
    ORACLE_CASTS.setdefault(_name, {}).update(_casts)


# ---------------------------------------------------------------------------
# Readers and sinks, over files that Spark writes from the given tables into the
# cluster's shared folder

import uuid  # noqa: E402

from quill.session import ensure_checkpoint_dir  # noqa: E402
from quill.sources import files, tasks  # noqa: E402


def _folder(spark, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def _put(spark, path: str, text: str) -> None:
    """One small file on shared storage."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


@register("conversations_jsonl", """
SELECT turn - min(turn) OVER (PARTITION BY conv_id) AS turn, role, md5(text) AS text_md5 FROM conversations
""")
def conversations_jsonl_q(spark, sf):
    """Written one array per line, read back, and put into the long form."""
    path = _folder(spark, "jsonl")
    sinks.write_conversations_jsonl(_t(spark, sf, "conversations"), path)
    turns = files.messages_to_turns(files.read_conversations_jsonl(spark, path))
    return turns.select(F.col("turn").cast("long").alias("turn"), "role", F.md5("text").alias("text_md5"))


_QA_STRIP = r"regexp_replace({x}, '^[\t\n\x0B\f\r \x1C-\x1F]+|[\t\n\x0B\f\r \x1C-\x1F]+$', '', 'g')"


@register("read_qa", r"""
SELECT q, a FROM (SELECT md5(""" + _QA_STRIP.format(x="text") + r""") AS q, CASE WHEN turn % 3 = 0 THEN NULL ELSE md5(role) END AS a,
                         """ + _QA_STRIP.format(x="text") + r""" AS s FROM conversations) WHERE a IS NOT NULL AND s <> ''
""")
def read_qa_q(spark, sf):
    c = _t(spark, sf, "conversations")
    qa = files.read_qa(c.select(F.concat(F.lit("\n "), F.col("text"), F.lit(" \t")).alias("question"),
                                F.when(F.col("turn") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("role"), F.lit("\n"))).alias("answer")))
    turns = F.col("messages")
    return qa.select(F.md5(turns[0]["content"]).alias("q"), F.md5(turns[1]["content"]).alias("a"))


@register("task_mmlu", f"""
SELECT md5(prompt) AS user_md5, chr((65 + idx % 4)::INT) AS answer, 'subject' || (idx % 3) AS subject, true AS valid FROM ({ORACLE["render_mc"]})
""")
def task_mmlu_q(spark, sf):
    it = _mc_items(spark, sf).select(F.col("query").alias("question"), "choices", F.col("gold").alias("answer"),
                                     F.concat(F.lit("subject"), (F.col("idx") % 3).cast("string")).alias("subject"))
    t = tasks.task_mmlu(it.select(F.struct("*").alias("train")), subset="auxiliary_train")
    return t.select(F.md5(F.col("messages")[0]["content"]).alias("user_md5"), F.col("messages")[1]["content"].alias("answer"), "subject", "valid")


@register("task_arc", f"""
SELECT md5(prompt) AS user_md5, CASE WHEN idx % 7 = 0 THEN 'Z' ELSE chr((65 + idx % 4)::INT) END AS answer, idx % 7 <> 0 AS valid FROM ({ORACLE["render_mc"]})
""")
def task_arc_q(spark, sf):
    it = _mc_items(spark, sf)
    rows = it.select(F.col("query").alias("question"), F.struct(F.array(*[F.lit(c) for c in "ABCD"]).alias("label"), F.col("choices").alias("text")).alias("choices"),
                     F.when(F.col("idx") % 7 == 0, "Z").otherwise(F.chr(F.col("gold") + 65)).alias("answerKey"))
    t = tasks.task_arc(rows)
    return t.select(F.md5(F.col("messages")[0]["content"]).alias("user_md5"), F.col("messages")[1]["content"].alias("answer"), "valid")


@register("task_gsm8k", f"""
SELECT md5(c.text) AS user_md5, types FROM ({ORACLE["parse_tool_calls"]}) p JOIN conversations c ON p.conv_id = c.conv_id AND p.turn = c.turn
""")
def task_gsm8k_q(spark, sf):
    c = _t(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("question"))
    t = tasks.task_gsm8k(_tool_answers(spark, sf).join(c, ["conv_id", "turn"]))
    return t.select(F.md5("user").alias("user_md5"), F.array_join(F.transform("assistant_parts", lambda x: x["type"]), ",").alias("types"))


@register("task_humaneval", """
SELECT md5(text) AS user_md5, md5(text || chr(10) || reverse(text)) AS assistant_md5, 'f' || item_id AS entry_point, 'check' AS test FROM benchmark
""")
def task_humaneval_q(spark, sf):
    b = _t(spark, sf, "benchmark")
    t = tasks.task_humaneval(b.select(F.col("text").alias("prompt"), F.reverse("text").alias("canonical_solution"),
                                      F.concat(F.lit("f"), F.col("item_id").cast("string")).alias("entry_point"), F.lit("check").alias("test")))
    return t.select(F.md5(F.col("messages")[0]["content"]).alias("user_md5"), F.md5(F.col("messages")[1]["content"]).alias("assistant_md5"), "entry_point", "test")


@register("read_word_list", "WITH " + _WORDS_SQL + " SELECT word FROM words")
def read_word_list_q(spark, sf):
    path = _folder(spark, "words")
    _words(spark, sf).select(F.concat(F.lit("  "), F.col("word"), F.lit(" ")).alias("value")).write.text(path)
    return files.read_word_list(spark, path)


@register("icl_bundle", """
SELECT 'task' || (item_id % 3) AS label, CASE item_id % 3 WHEN 0 THEN 'multiple_choice' WHEN 1 THEN 'schema' ELSE 'language_modeling' END AS task_type,
       (item_id % 3) * 5 AS num_fewshot, CASE item_id % 3 WHEN 0 THEN chr(10) || 'Answer: ' ELSE ' ' END AS continuation_delimiter,
       0.25 * (item_id % 3) AS baseline, count(*) AS n_items, sum(length(text))::BIGINT AS n_chars FROM benchmark GROUP BY ALL
""")
def icl_bundle_q(spark, sf):
    """A bundle written from the benchmark (config, baselines, items) and read back."""
    path = _folder(spark, "bundle")
    kinds = ["multiple_choice", "schema", "language_modeling"]
    entries = "".join(f"- label: task{i}\n  icl_task_type: {k}\n  dataset_uri: task{i}.jsonl\n  num_fewshot: [{i * 5}, 9]\n"
                      + ('  continuation_delimiter: "\\nAnswer: "\n' if i == 0 else "") for i, k in enumerate(kinds))
    _put(spark, f"{path}/core.yaml", "icl_tasks:\n" + entries)
    _put(spark, f"{path}/eval_meta_data.csv", "Eval Task,Random baseline\n" + "".join(f"task{i},{0.25 * i}\n" for i in range(3)))
    b = _t(spark, sf, "benchmark")
    for i in range(3):
        b.where(F.col("item_id") % 3 == i).select("item_id", "text").write.json(f"{path}/eval_data/task{i}.jsonl")
    config, baselines, items = tasks.read_icl_bundle(spark, path)
    out = None
    for t in config:
        d = items[t["label"]].agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.length("text")).alias("n_chars")).select(
            F.lit(t["label"]).alias("label"), F.lit(t["task_type"]).alias("task_type"), F.lit(t["num_fewshot"]).cast("long").alias("num_fewshot"),
            F.lit(t["continuation_delimiter"]).alias("continuation_delimiter"), "n_items", "n_chars")
        out = d if out is None else out.unionByName(d)
    return out.join(baselines.withColumnRenamed("task", "label"), "label")


@register("shard_manifest", """
SELECT i AS shard_idx, 'missing' AS status FROM (SELECT unnest(range((SELECT ceil(count(*) / 64.0)::BIGINT + 3 FROM documents))) AS i)
WHERE i >= (SELECT ceil(count(*) / 64.0)::BIGINT FROM documents)
""")
def shard_manifest_q(spark, sf):
    path = _folder(spark, "shards")
    docs = _t(spark, sf, "documents")
    sinks.write_shards_by_rows(docs, path, "doc_id", rows=64)
    return files.shard_manifest(spark, path, -(-docs.count() // 64) + 3)


@register("publish_shards", "SELECT true AS first_written, false AS second_written, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars FROM documents")
def publish_shards_q(spark, sf):
    path = _folder(spark, "published") + "/corpus"
    docs = _t(spark, sf, "documents")

    def write(p):
        sinks.write_shards_by_chars(docs, p, "doc_id", budget=100_000, group=16)
    first, second = sinks.publish(spark, write, path), sinks.publish(spark, write, path)
    return files.read_corpus(spark, path).agg(F.lit(first).alias("first_written"), F.lit(second).alias("second_written"),
                                              F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


@register("artifact_catalog", """
WITH f AS (SELECT 'd' || (o_custkey % 7) AS tag, o_orderkey AS step, o_orderdate AS mtime FROM orders WHERE o_orderkey % 5 <> 0)
SELECT tag, max(step)::BIGINT AS last_step, max(mtime)::VARCHAR AS mtime, tag = (SELECT max(tag) FROM f) AS is_default FROM f GROUP BY tag
""")
def artifact_catalog_q(spark, sf):
    o = _t(spark, sf, "orders")
    name = F.format_string("%s_%06d.pt", F.when(F.col("o_orderkey") % 5 == 0, "optim").otherwise("model"), F.col("o_orderkey"))
    listing = o.select(F.concat(F.lit("d"), (F.col("o_custkey") % 7).cast("string")).alias("tag"), name.alias("file_name"), F.col("o_orderdate").alias("mtime"))
    return files.artifact_catalog(listing).withColumn("mtime", F.col("mtime").cast("string"))


@register("apply_merges", _TRAIN_SQL + f"""SELECT md5(c) AS chunk_md5, replace(trim(tok, '<>'), '><', ',') AS ids FROM final
WHERE c IN (SELECT unnest(regexp_extract_all(text, '{_RE2}', 1)) FROM documents)""")
def apply_merges_q(spark, sf):
    m = [(r["left"], r["right"], r.new_id) for r in trained_merges(spark, sf).orderBy("rank").collect()]
    words = bpe.words_from_chunks(bpe.chunk_counts(_t(spark, sf, "documents")))
    return words.select(F.md5("chunk").alias("chunk_md5"), F.array_join(bpe.apply_merges_col(F.col("ids"), m), ",").alias("ids"))


@register("results_csv", _CENTER_SQL + """
SELECT task, accuracy, centered FROM c UNION ALL SELECT 'CORE', NULL, round(avg(centered), 6) FROM c
""")
def results_csv_q(spark, sf):
    path = _folder(spark, "results")
    sinks.write_results_csv(_centered(spark, sf), path)
    return spark.read.option("header", True).schema("task string, accuracy double, centered double").csv(path)


@register("option_spans_lm", """
SELECT item_id, greatest(length(text) - 7, 0) AS start, length(text) AS "end", true AS is_prefix FROM benchmark
""")
def option_spans_lm_q(spark, sf):
    codes = F.transform(F.split("text", ""), lambda x: F.ascii(x))
    b = _t(spark, sf, "benchmark").select("item_id", codes.alias("ids_with"))
    b = b.withColumn("ids_without", F.slice("ids_with", 1, F.greatest(F.size("ids_with") - 7, F.lit(0))))
    return pack.lm_spans(b).select("item_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "is_prefix")


@register("parse_reports", """
WITH m AS (SELECT 'r' || (doc_id % 2) AS run, CASE doc_id % 3 WHEN 0 THEN 'base-model-evaluation' WHEN 1 THEN 'chat-sft' ELSE 'chat-rl' END AS section, count(*) AS n,
                  round(avg(quality), 4) AS q FROM labels GROUP BY 1, 2)
SELECT run, section, 'documents' AS key, n::VARCHAR AS value, CASE section WHEN 'base-model-evaluation' THEN 5 WHEN 'chat-sft' THEN 8 ELSE 10 END AS section_no, 5400 AS wall_seconds FROM m
UNION ALL SELECT run, section, 'quality', q::VARCHAR, CASE section WHEN 'base-model-evaluation' THEN 5 WHEN 'chat-sft' THEN 8 ELSE 10 END, 5400 FROM m
""")
def parse_reports_q(spark, sf):
    """Reports of two runs written from the labels, parsed, with their wall clock."""
    path = _folder(spark, "reports")
    sections = ["base-model-evaluation", "chat-sft", "chat-rl"]
    lab = _t(spark, sf, "labels")
    rows = lab.groupBy((F.col("doc_id") % 2).alias("r"), (F.col("doc_id") % 3).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("quality"), 4).cast("string").alias("q")).collect()     # six rows
    for r in rows:
        _put(spark, f"{path}/r{r.r}/{sections[r.s]}.md",
             f"## Section\ntimestamp: 2024-01-01 0{r.s + 1}:30:00\n\n- documents: {r.n}\n- quality: {r.q}\n")
        _put(spark, f"{path}/r{r.r}/header.md", "# Report\n\nRun started: 2024-01-01 01:00:00\n")
    kv = evals.parse_reports(spark, path)
    wall = evals.wall_clock(kv, ts="ts").select("run", F.col("seconds").alias("wall_seconds"))
    return (kv.where(F.col("key").isin("documents", "quality")).join(wall, "run")
            .select("run", "section", "key", "value", F.col("section_no").cast("long").alias("section_no"), "wall_seconds"))


for _name, _casts in {"conversations_jsonl": {"turn": "BIGINT"}, "icl_bundle": {"num_fewshot": "BIGINT", "baseline": "DOUBLE"}, "shard_manifest": {"shard_idx": "BIGINT"},
                      "option_spans_lm": {"start": "BIGINT", "end": "BIGINT"}, "parse_reports": {"section_no": "BIGINT", "wall_seconds": "BIGINT"}}.items():
    ORACLE_CASTS.setdefault(_name, {}).update(_casts)


# ---------------------------------------------------------------------------
# Content with parts, tasks as data, the buffered shuffle as a stream

from quill.operators import content  # noqa: E402
from quill.operators.task import Task, evaluate  # noqa: E402
from quill.streaming.shuffle import BufferedShuffle  # noqa: E402


def _hex_ids(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::INT)"


def _ids(*parts: str) -> str:
    """SQL list of the ids of special tokens (by name) and texts (in parentheses), with 256 byte tokens."""
    lists = [f"[{256 + tx.SPECIAL_TOKENS.index(f'<|{p}|>')}]" if not p.startswith("(") else _hex_ids(p) for p in parts]
    return "flatten([" + ", ".join(lists) + "])"


@register("render_parts_jsonl", f"""
WITH c AS (SELECT conv_id, turn, role, text, lag(role) OVER w = 'system' AND turn = 1 AS after_system, lag(text) OVER w AS before
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
m AS (SELECT conv_id, turn, role, CASE WHEN after_system THEN before || chr(10) || chr(10) || text ELSE text END AS text,
             turn = 0 OR coalesce(after_system, false) AS leads, (conv_id + turn) % 2 = 0 AS split, length(text) // 2 AS h FROM c WHERE NOT (turn = 0 AND role = 'system')),
s AS (SELECT conv_id, turn,
  CASE WHEN leads THEN [256] ELSE CAST([] AS INT[]) END || CASE WHEN role = 'user' THEN {_ids('user_start', '(text)', 'user_end')}
    WHEN split THEN {_ids('assistant_start', '(substring(text, 1, h))', 'python_start', '(CAST(h AS VARCHAR))', 'python_end', 'output_start', "('=' || h)", 'output_end', '(substring(text, h + 1))', 'assistant_end')}
    ELSE {_ids('assistant_start', '(text)', 'assistant_end')} END AS ids,
  CASE WHEN role = 'user' THEN 0 WHEN split THEN strlen(text) + length(CAST(h AS VARCHAR)) + 3 ELSE strlen(text) + 1 END AS supervised FROM m),
r AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS ids, sum(supervised) AS supervised FROM s GROUP BY conv_id)
SELECT md5(array_to_string(ids, ',')) AS ids_md5, len(ids) AS n_ids, supervised::BIGINT AS supervised FROM r
""")
def render_parts_jsonl_q(spark, sf):
    """Conversations written as JSON lines, half of the assistants' answers as lists of parts, read
    back in both shapes and rendered with the 256 byte tokens."""
    c = _t(spark, sf, "conversations")
    half = F.floor(F.length("text") / 2).cast("int")

    def part(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))
    parts = F.array(part("text", F.substr("text", F.lit(1), half)), part("python", half.cast("string")),
                    part("python_output", F.concat(F.lit("="), half.cast("string"))), part("text", F.substr("text", half + 1)))
    split = (F.col("role") == "assistant") & ((F.col("conv_id") + F.col("turn")) % 2 == 0)
    as_json = F.concat(F.lit('{"role":"'), F.col("role"), F.lit('","content":'),
                       F.when(split, F.to_json(parts)).otherwise(F.regexp_replace(F.to_json(F.struct(F.col("text").alias("c"))), r'^\{"c":|\}$', "")), F.lit("}"))
    lines = c.select("conv_id", "turn", as_json.alias("m")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "m"))).alias("ms"))
    path = _folder(spark, "parts") + "/lines"
    lines.select(F.concat(F.lit("["), F.array_join(F.transform("ms", lambda x: x["m"]), ","), F.lit("]")).alias("value")).write.text(path)
    segments = content.render_parts(content.read_parts_jsonl(spark, path))
    empty = spark.createDataFrame([], "rank INT, left INT, right INT, new_id INT, cnt LONG")
    r = chat.render_conversation(None, empty, max_tokens=1 << 30, key="conv", segments=segments)
    return r.select(F.md5(F.array_join("ids", ",")).alias("ids_md5"), F.size("ids").alias("n_ids"), chat.supervised_tokens(r).alias("supervised"))


@register("evaluate_tasks", """
WITH mc AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS i, chr((65 + item_id % 4)::INT) AS ref FROM benchmark),
num AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, length(text) AS ref FROM conversations),
ex AS (SELECT 'letters' AS task, (i - 1) // 2 AS idx, ref FROM mc WHERE i >= 1 AND (i - 1) % 2 = 0
       UNION ALL SELECT 'numbers', i, CAST(ref AS VARCHAR) FROM num),
s AS (SELECT task, idx, n, CASE WHEN task = 'letters' THEN chr((65 + (idx + n) % 5)::INT) = ref ELSE (idx + n) % 3 = 0 END AS ok FROM ex, range(3) r(n)),
p AS (SELECT task, idx, avg(ok::INT) AS m, max(ok::INT) AS a FROM s GROUP BY 1, 2)
SELECT task, count(*) AS n, round(avg(m), 6) AS mean, round(avg(a), 6) AS any FROM p GROUP BY task
""")
def evaluate_tasks_q(spark, sf):
    """A multiple-choice and a numeric task graded in one plan, three completions an example."""
    four = F.array(*[F.lit(x) for x in "ABCD"])
    mc = Task("letters", _t(spark, sf, "benchmark"), "item_id", {"prompt": F.col("text"), "reference": F.chr(F.col("item_id") % 4 + 65), "letters": four},
              lambda ref, done, letters: evals.grade_letter(ref, done, letters), start=1, step=2)
    answers = _t(spark, sf, "conversations").withColumn("at", F.struct("conv_id", "turn"))
    numbers = Task("numbers", answers, "at", {"prompt": F.col("text"), "reference": F.concat(F.lit("so #### "), F.length("text").cast("string"))},
                   lambda ref, done, _: evals.grade_numeric(ref, done))
    many = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("sample_no")
    i = F.col("idx") + F.col("sample_no")
    said = F.when(F.col("task") == "letters", F.chr(i % 5 + 65)).when(i % 3 == 0, F.col("reference")).otherwise(F.concat(F.col("reference"), F.lit("9")))
    done = (mc.examples().unionByName(numbers.examples()).select("task", "idx", "reference", many)
            .select("task", "idx", "sample_no", said.alias("completion")))
    return evaluate([mc, numbers], done)


@register("shuffle_stream", ORACLE["shuffle_buffered"].replace(" WHERE rank < 20000", ""))
def shuffle_stream_q(spark, sf):
    """The buffered shuffle over micro-batches of a sharded corpus, every sentence kept."""
    base = _folder(spark, "shuffle")
    docs = sinks.shard_by_rows(_t(spark, sf, "documents"), "doc_id", rows=256)
    write_shards(docs.select("__pos", "doc_id", "text", "shard"), base + "/corpus", ["__pos"], row_group_rows=64)
    s = stream_epochs(spark, base + "/corpus", base + "/progress", "doc_id bigint, text string", groups=6, epochs=1, grow=2)
    mixer = BufferedShuffle(base, corpus.sentences, n=2000)
    q = s.writeStream.foreachBatch(mixer).option("checkpointLocation", base + "/ckpt").start()
    q.processAllAvailable()
    q.stop()
    return mixer.finish(spark, _batches(spark, base)).select("doc_id", "pos", "buffer", "rank")


def _batches(spark, base: str) -> int:
    return 1 + spark.read.parquet(base + "/position").agg(F.max("batch")).collect()[0][0]


@register("score_lm_spans", """
WITH p AS (SELECT l_orderkey AS item, l_linenumber AS pos, l_suppkey % 3 AS pred, l_partkey % 3 AS actual FROM lineitem),
s AS (SELECT item, min(pos) + 1 AS "start", min(pos) + 3 AS "end" FROM p GROUP BY item)
SELECT s.item, coalesce(bool_and(pred = actual), true) AS is_correct
FROM s LEFT JOIN p ON p.item = s.item AND pos >= "start" - 1 AND pos < "end" - 1 GROUP BY s.item
""")
def score_lm_spans_q(spark, sf):
    li = _t(spark, sf, "lineitem")
    p = li.select(F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("pos"), (F.col("l_suppkey") % 3).alias("pred"), (F.col("l_partkey") % 3).alias("actual"))
    spans = p.groupBy("item").agg((F.min("pos") + 1).alias("start"), (F.min("pos") + 3).alias("end"))
    return evals.score_lm(p, spans=spans)


@register("training_budget_rules", """
WITH c AS (SELECT lang, sum(length(text))::BIGINT AS tokens, count(*) * 1.0 AS chars_per_token FROM documents GROUP BY lang),
r AS (SELECT 'flops' AS rule, 1907 AS n UNION ALL SELECT 'ratio', 10700 UNION ALL SELECT 'given', 77)
SELECT lang, rule, n::BIGINT AS num_iterations, round(524288.0::DOUBLE * n / 561000000, 6) AS tokens_per_param FROM c, r
""")
def training_budget_rules_q(spark, sf):
    """Iterations from a compute target, from tokens per parameter, and as given."""
    c = _t(spark, sf, "documents").groupBy("lang").agg(F.sum(F.length("text")).alias("tokens"), F.count(F.lit(1)).cast("double").alias("chars_per_token"))
    rules = {"flops": {"target_flops": 1e18, "flops_per_token": 1e9}, "ratio": {"param_data_ratio": 10.0}, "given": {"num_iterations": 77}}
    out = None
    for lang in sorted(r.lang for r in c.select("lang").collect()):
        for rule, options in rules.items():
            one = pack.training_budget(c.where(F.col("lang") == lang), 524_288, 561_000_000, **options).select(
                F.lit(lang).alias("lang"), F.lit(rule).alias("rule"), "num_iterations", "tokens_per_param")
            out = one if out is None else out.unionByName(one)
    return out


@register("read_qa_messages", """
SELECT DISTINCT conv_id, count(*) OVER (PARTITION BY conv_id) AS n_messages, md5(string_agg(role || ':' || text, '|') OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS messages_md5 FROM conversations
""")
def read_qa_messages_q(spark, sf):
    """The ``messages`` branch of the Q/A reader over conversations written as JSON."""
    c = sinks.conversations_jsonl(_t(spark, sf, "conversations"))
    rows = c.select("conv_id", F.col("value").alias("messages"))
    read = files.read_qa(rows.select("messages")).select("messages").distinct()
    named = rows.select("conv_id", F.from_json("messages", read.schema["messages"].dataType).alias("messages")).join(read, "messages")
    line = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return named.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"), F.md5(line).alias("messages_md5"))


@register("completion_prompt", f"""
SELECT conv_id, count(*) AS n_segments, md5(string_agg(kind || ':' || value || ':' || mask, '|' ORDER BY seg_no)) AS segments_md5
FROM ({ORACLE["render_completion_segments"]}) GROUP BY conv_id
""")
def completion_prompt_q(spark, sf):
    """Prompts for the last answer of each conversation, through the common form of content."""
    s = content.completion_prompt(content.parts_of_text(_t(spark, sf, "conversations")), key="conv_id")
    one = F.concat_ws(":", "kind", "value", F.col("mask").cast("string"))
    g = s.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg_no", one.alias("x")))).alias("xs"))
    return g.select("conv_id", F.size("xs").cast("bigint").alias("n_segments"), F.md5(F.array_join(F.transform("xs", lambda x: x["x"]), "|")).alias("segments_md5"))
