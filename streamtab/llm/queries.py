"""The queries of the operators and of the pipeline, over whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from streamtab.llm import chat, decontam, license, lines, lm, minhash, mix, partenum, planes, quality, spelling, tokens, warc
from streamtab.llm.common import saved
from streamtab.llm.registry import QUERIES, SQL, query  # noqa: F401
from streamtab.sources.files import table

_CHAT_SQL = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(/?(?:s>|INST\\]))', '\\1\\\\\\2\\3', 'g') AS et,
            regexp_replace(role, '([<\\[])(\\\\*)(/?(?:s>|INST\\]))', '\\1\\\\\\2\\3', 'g') AS er FROM r
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(CAST(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 20) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op1_chat_formatting", _CHAT_SQL)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string"
    )
    formatted = chat.format_conversations(chat.conversations(rows.unionByName(extra)))
    return chat.digests(saved(spark, formatted, "chat")).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


_LICENSE_SQL = f"""
WITH known AS (
  SELECT sha256({license.canonical_sql("t")}) AS digest, min(i) AS license_id FROM (VALUES
  {", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in sorted(license.KNOWN.items()))}) AS v(i, t)
  GROUP BY 1
), c AS (SELECT doc_id, {license.canonical_sql("text")} AS clean FROM documents)
SELECT doc_id, sha256(clean) AS license_digest, CAST(length(clean) AS BIGINT) AS canonical_chars, license_id
FROM c LEFT JOIN known ON sha256(clean) = digest
"""


@query("op8_license_scan", _LICENSE_SQL)
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license.scan(docs, license.known_licenses(spark)).select("doc_id", "license_digest", "canonical_chars", "license_id")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
b AS (SELECT *, list_transform(generate_series(0, 7), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5) AS INTEGER)) AS q FROM s),
d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(q, lambda v:
        substr('{_BASE32}', (v // 32768) % 32 + 1, 1) || substr('{_BASE32}', (v // 1024) % 32 + 1, 1) ||
        substr('{_BASE32}', (v // 32) % 32 + 1, 1) || substr('{_BASE32}', v % 32 + 1, 1)), 'string_agg', '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""


@query("op9_warc_archives", _WARC_SQL)
def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    manifest = warc.write_archives(spark, warc.mark_revisits(spark, pages))
    return warc.read_archives(manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mix.mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    return quality.assess(docs, forest)


@query("op6_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.checksums(tokens.read_metadata(spark, tokens.write_tokens(spark, docs), ids=True))


# Every pair of equal lines, the stretches that pairs form along two documents, and the later lines of those that are long enough.
_LINES_SQL = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS nth, * FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
s AS (SELECT nth, string_split(text, chr(10)) AS ls FROM d),
l AS (SELECT nth, i, ls[i] AS line, len(regexp_extract_all(ls[i], '[^\\x20\\x09-\\x0D]+')) AS words
      FROM (SELECT nth, ls, unnest(generate_series(1, len(ls))) AS i FROM s)),
p AS (SELECT a.nth, a.i, a.words, b.nth AS other, a.i - b.i AS shift FROM l a JOIN l b ON a.line = b.line AND (b.nth < a.nth OR (b.nth = a.nth AND b.i < a.i))),
g AS (SELECT *, i - row_number() OVER (PARTITION BY nth, other, shift ORDER BY i) AS run FROM p),
r AS (SELECT nth, min(i) AS low, max(i) AS high FROM g GROUP BY nth, other, shift, run HAVING sum(words) >= {lines.MIN_WORDS}),
x AS (SELECT DISTINCT nth, unnest(generate_series(low, high)) AS i FROM r),
kept AS (SELECT l.nth, count(*) FILTER (x.i IS NOT NULL) AS n_deleted,
                coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (x.i IS NULL), '') AS left_text
         FROM l LEFT JOIN x ON l.nth = x.nth AND l.i = x.i GROUP BY l.nth),
o AS (SELECT d.doc_id, d.text, n_deleted, left_text FROM kept JOIN d ON kept.nth = d.nth)
SELECT s.doc_id, CAST(CASE WHEN s.text IS NULL THEN 0 ELSE len(string_split(s.text, chr(10))) END AS BIGINT) AS n_lines,
       coalesce(n_deleted, 0) AS n_deleted, CAST(length(left_text) AS BIGINT) AS kept_chars, md5(left_text) AS kept_md5
FROM documents s LEFT JOIN o ON s.doc_id IS NOT DISTINCT FROM o.doc_id AND s.text = o.text
"""


@query("op2_line_dedup", _LINES_SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.dedup_lines(spark, docs).select(
        "doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5")
    )


@query("op5_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontam.find_copies(spark, docs, table(spark, folder, "benchmark").select("item_id", "text"))


@query("op4_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return partenum.near_groups(spark, docs).select("doc_id", "n_shingles", "component_id")


@query("op7_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(spark, table(spark, folder, "documents").select("doc_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MINHASH_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(list_slice(ws, i, i + {minhash.SHINGLE - 1}), ' ') AS shingle
  FROM (SELECT rid, ws, unnest(generate_series(1, greatest(len(ws) - {minhash.SHINGLE - 1}, 1))) AS i FROM d WHERE len(ws) > 0)
), c AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.rid < b.rid GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN c a ON x = a.rid JOIN c b ON y = b.rid WHERE 100 * common >= {minhash.PERCENT} * (a.n + b.n - common)
), both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(x, y) AS (SELECT rid, rid FROM d UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
least AS (SELECT reach.x AS rid, min(doc_id) AS component_id FROM reach JOIN d ON reach.y = d.rid GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN c USING (rid) JOIN least USING (rid)
"""


@query("op11_minhash_dedup", _MINHASH_SQL)
def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return minhash.near_copies(spark, docs).select("doc_id", "n_shingles", "component_id", "kept")


def _planes_sql() -> str:
    """One block of expressions per round."""
    apart = "list_sum(list_transform(generate_series(1, 64), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k, v AS c FROM (SELECT sha256('3:' || vec_id) AS h, v FROM v) ORDER BY k LIMIT 8
)"""
    ]
    for r in range(planes.ROUNDS + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(row(apart, k)) AS best
  FROM (SELECT rid, vec_id, v, k, CAST({apart} AS BIGINT) AS apart FROM v CROSS JOIN c{r}) GROUP BY rid)"""
        )
        if r < planes.ROUNDS:
            parts.append(
                f"""t{r} AS (SELECT best[2] AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY ALL),
m{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM t{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))"""
            )
    last = planes.ROUNDS
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON best[2] = k"""


@query("op12_centroid_clustering", _planes_sql())
def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return planes.cluster_vectors(spark, table(spark, folder, "embeddings").select("vec_id", "embedding"))


# CRC-32 by its table, which follows from the polynomial; near words share the word with one code point gone or masked.
_SPELLING_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), generate_series(1, 8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(generate_series(0, 255)) AS b)
), r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents) GROUP BY ALL
), h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
           generate_series(1, octet_length(encode(m))), lambda i: CAST('0x' || substr(hex(encode(m)), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS m FROM r), crc
), f AS (
  SELECT CASE WHEN h % {spelling.EDIT_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY word HAVING length(word) >= {spelling.LETTERS} AND sum(n) >= {spelling.OCCURRENCES}
), k AS (
  SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) AS short, i, substr(word, 1, i - 1) || ' ' || substr(word, i + 1) AS masked
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM w)
), p AS MATERIALIZED (
  SELECT DISTINCT a.word AS x, b.word AS y FROM k a JOIN k b ON a.masked = b.masked AND a.word <> b.word
  UNION SELECT k.word, w.word FROM k JOIN w ON k.short = w.word
  UNION SELECT w.word, k.word FROM k JOIN w ON k.short = w.word
), b AS (
  SELECT x, count(*) AS n_near, min(row(-n, y)) AS best FROM p JOIN w ON p.y = w.word GROUP BY x
), g AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {spelling.RATIO} * n THEN best[2] END AS form,
         CASE WHEN -best[1] >= {spelling.RATIO} * n THEN -best[1] END AS form_n
  FROM w LEFT JOIN b ON word = x
), chain AS (
  WITH RECURSIVE steps(word, root) AS (SELECT word, word FROM g UNION ALL SELECT steps.word, g.form FROM steps JOIN g ON root = g.word AND g.form IS NOT NULL)
  SELECT steps.word, root FROM steps JOIN g ON root = g.word AND g.form IS NULL
)
SELECT g.word, form, root, n, n_near, form_n FROM g JOIN chain USING (word)
"""


@query("op13_spelling_groups", _SPELLING_SQL)
def spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling.group_spellings(spark, docs).select("word", "form", "root", "n", "n_near", "form_n")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
