"""Queries of the training-data operators, and their DuckDB statements where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import bpe_codec, chat_format, html_text, language_id, lexical_search, mixing, near_dedup, nearest, packing, quality_model, quality_rules, resampling, token_files
from lodestrata.llm.storage import Workspace, load

WORDS = r"[^\x20\x09-\x0D]+"


def held_out(key: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(load(spark, sf_dir, "pages"))


#: For pages whose article is one <article> element of prose, as in the test tables; general markup is no SQL.
OP1_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), ''), '</?(p|h1|br)>', ' ', 'g'), '<[^>]+>', '', 'g') AS t FROM pages
), d AS (SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM a
), x AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM d)
SELECT page_id::BIGINT AS page_id, url, text, length(text)::BIGINT AS n_chars FROM x
"""


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = load(spark, sf_dir, "documents")
    folder = f"{Workspace(spark, 'op3').root}/files"
    token_files.write_files(token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2), folder)
    return token_files.read_token_files(spark, folder)


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(~held_out())
    scored = quality_model.score_documents(docs, quality_model.learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    written = Workspace(spark, "op5").table(chat_format.format_conversations(rows.unionByName(more)), "formatted")
    turns, loss = chat_format.parse(F.col("formatted")), F.col("loss")
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return (
        written.select("conv_id", "formatted", turns.alias("turns"), chat_format.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", line), "").cast("binary"), 256).alias("turns_sha256"),
            F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


OP5_SQL = r"""
WITH everything AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, 14 + length(role) + length(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS shown FROM everything
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(shown)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id::BIGINT AS doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
), u AS (SELECT doc_id, unnest(sh) AS x FROM s
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * c >= 75 * (len(sa.sh) + len(sb.sh) - c)
), l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.root = l.a
), c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.measure_quality(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), b AS (SELECT r, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars FROM w
), l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), u AS (SELECT r, line, count(*) AS c, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM l GROUP BY r, line HAVING length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) > 0
), x AS (SELECT r, sum(c - 1)::BIGINT AS n_dup_lines, sum((c - 1) * chars)::BIGINT AS dup_chars FROM u GROUP BY r
), g AS (SELECT r, k, i, array_to_string(ws[i:i + k - 1], ' ') AS gram FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (3), (5), (7), (10)) v(k)) s
), p AS (SELECT r, k, gram FROM g GROUP BY r, k, gram HAVING count(*) > 1
), h AS (SELECT DISTINCT r, k, unnest(range(i, i + k)) AS j FROM g JOIN p USING (r, k, gram)
), z AS (SELECT h.r, k, count(*) AS n, sum(length(ws[j])) AS chars FROM h JOIN w ON w.r = h.r GROUP BY h.r, k
), y AS (SELECT r, max(n) FILTER (WHERE k = 3) AS n3, max(chars) FILTER (WHERE k = 5) AS c5, max(chars) FILTER (WHERE k = 7) AS c7, max(chars) FILTER (WHERE k = 10) AS c10 FROM z GROUP BY r
), f AS (
  SELECT doc_id, n_words, word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n3, 0)::BIGINT AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n3, 0) > 50 * n_words AS base_failed, coalesce(dup_chars, 0)::DOUBLE / greatest(word_chars, 1) AS sl, coalesce(c5, 0)::DOUBLE / greatest(word_chars, 1) AS s5,
    coalesce(c7, 0)::DOUBLE / greatest(word_chars, 1) AS s7, coalesce(c10, 0)::DOUBLE / greatest(word_chars, 1) AS s10
  FROM d JOIN b USING (r) LEFT JOIN x USING (r) LEFT JOIN y USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND sl <= 0.15::DOUBLE AND s5 <= 0.3::DOUBLE AND s7 <= 0.28::DOUBLE AND s10 <= 0.2::DOUBLE AS kept FROM f
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    learned = language_id.model(language_id.learn(docs.where(~held_out())))
    return language_id.predict(docs, learned).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    sized = Workspace(spark, "op9").table(packing.measured(docs, True), "sized")
    packed = packing.pack(docs, near=packing.near_clusters(docs, sized), sized=sized)
    return packed.select("doc_id", "piece", "start_word", "n_words", "bin_id", "bin_offset")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return nearest.search(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe_codec.encode(load(spark, sf_dir, "documents"), path)
    digests = coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    back = bpe_codec.decode(digests, path, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


#: crc32 by halves of bytes: its table of sixteen numbers comes from the polynomial.
OP12_SQL = r"""
WITH h AS (SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS half
), d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), t AS (SELECT row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), f AS (
  SELECT 0 AS side, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS x FROM d
  UNION ALL SELECT 1, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) FROM t
), e AS (SELECT DISTINCT x, hex(encode(x)) AS digits FROM f
), b AS (
  SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(digits), 2), lambda i: [strpos('0123456789ABCDEF', digits[i + 1]) - 1, strpos('0123456789ABCDEF', digits[i]) - 1]))),
    lambda c, v: xor(c >> 4, half[(xor(c, v) & 15) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM e, h
), c AS (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM f JOIN b USING (x) GROUP BY bucket
), g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM c
), w AS (SELECT r, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS total FROM f JOIN b USING (x) JOIN g USING (bucket) WHERE side = 0 GROUP BY r
), k AS (
  SELECT doc_id::BIGINT AS doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d LEFT JOIN w USING (r)
), s AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM k
), o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS n FROM s
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END::BIGINT AS rank FROM o
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id::BIGINT AS doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), i AS (SELECT row_number() OVER () AS q, item_id::BIGINT AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark
), g AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0
), x AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(ts) AS t FROM i) u GROUP BY q, t
), p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) u WHERE t IN (SELECT t FROM x) GROUP BY r, t
), w AS (SELECT t, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY t
), m AS (SELECT r, doc_id, 75 + (25 * len(ts) * n) // l AS m FROM d, g WHERE len(ts) > 0
), s AS (SELECT q, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM x JOIN p USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY q, r, doc_id
), o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s JOIN i USING (q) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_text": op1_html_text,
        "op2_near_dedup": op2_near_dedup,
        "op3_token_files": op3_token_files,
        "op4_quality_model": op4_quality_model,
        "op5_chat_format": op5_chat_format,
        "op6_quality_rules": op6_quality_rules,
        "op7_mixing": op7_mixing,
        "op8_language_id": op8_language_id,
        "op9_packing": op9_packing,
        "op10_nearest": op10_nearest,
        "op11_bpe_codec": op11_bpe_codec,
        "op12_resampling": op12_resampling,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_html_text": OP1_SQL, "op2_near_dedup": OP2_SQL, "op5_chat_format": OP5_SQL, "op6_quality_rules": OP6_SQL, "op12_resampling": OP12_SQL, "op13_lexical_search": OP13_SQL}
