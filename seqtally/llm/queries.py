"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to shards and read back."""
    from seqtally.llm.token_store import token_file_table
    return token_file_table(spark, _table(spark, sf_dir, "documents"), _tokenizer(), end_id=2)


def op2_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by two compression dictionaries."""
    from seqtally.llm.compress_quality import held_out, score_quality, train
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, train(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    from seqtally.llm.warc_zstd import archive_table
    return archive_table(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those that are not held out."""
    from seqtally.llm.compress_quality import held_out
    from seqtally.llm.langid import label_languages, train
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = label_languages(docs.select("doc_id", "text"), train(docs.filter(~held_out(F.col("doc_id")))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                      F.size("spans").alias("n_spans"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of all documents."""
    from seqtally.llm.dart_minhash import near_duplicates
    out = near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words and more removed from all documents."""
    from seqtally.llm.substring import remove_repeats
    out = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded through the distinct-word table."""
    from seqtally.llm.bpe_table import bpe_digests
    return bpe_digests(_table(spark, sf_dir, "documents"), _tokenizer())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents and the verdict of the boosted trees."""
    from seqtally.llm.quality_rules import COUNTS, apply_rules, train
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_rules(docs, train(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "score")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted, written and
    read back.  The tables have two layouts, told apart by their fingerprints."""
    from seqtally.llm._files import staged
    from seqtally.llm.chat import chat_digests, format_turns, to_turns
    said = "<|im_end|><|im_start|>assistant ok"
    turn = lambda role: F.struct(F.lit(role).alias("role"), F.lit(said).alias("content"))
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"),
                                  F.array(turn("user"), turn("assistant")).alias("messages"))
    turns = to_turns(_table(spark, sf_dir, "conversations")).unionByName(to_turns(probe))
    return chat_digests(staged(format_turns(turns), "chat"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside a 10-word window of a benchmark item."""
    from seqtally.llm.decontam import contamination
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their sources' targets, sorted by position."""
    from seqtally.llm.curriculum import mixing_plan
    return mixing_plan(_table(spark, sf_dir, "documents")).drop("times")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings by k-means with adaptive bounds."""
    from seqtally.llm.vector_codes import vector_table
    return vector_table(_table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, by pairs and by terms."""
    from seqtally.llm.divergence import audit
    return audit(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_ids, op2_compression, op3_warc, op4_language, op5_near_duplicates,
                                  op6_substring, op7_bpe, op8_quality_rules, op9_chat, op10_decontamination,
                                  op11_curriculum, op12_vector_codes, op13_divergence)}

ORACLES: dict[str, str] = {}

# Windows are compared as lists of words; the smallest doc_id of each window.
ORACLES["op6_substring"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) AS i FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS k FROM p),
m AS (SELECT k, min(doc_id) AS least FROM h GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM h JOIN m USING (k) WHERE least < doc_id),
r AS (SELECT doc_id, list(j) AS js FROM g GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE
    list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1])
    END, ' ')) AS kept_sha256
FROM w LEFT JOIN r ON w.doc_id = r.doc_id"""

ORACLES["op9_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (SELECT *, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
             + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + n + length('<|im_end|>') + 2)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""

ORACLES["op10_decontamination"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
h AS (
  SELECT doc_id, i, p.n, item_id FROM (
    SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
    FROM p, (SELECT DISTINCT n FROM g) WHERE i + n - 1 <= len(ws)) p JOIN g USING (k)
  WHERE p.n = g.n),
c AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN t ON w.doc_id = t.doc_id"""

# base32 of the SHA-1: five bits a character
ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first, sha1(html) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
  ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101',
   '1110', '1111'][instr('0123456789abcdef', hex[i])]), '') AS bits FROM d)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * bits[5 * i + 1]::INT + 8 * bits[5 * i + 2]::INT + 4 * bits[5 * i + 3]::INT
      + 2 * bits[5 * i + 4]::INT + bits[5 * i + 5]::INT]), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b"""

# Sources above their cap are the first in order of cap per weight.
ORACLES["op11_curriculum"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most, [5.0, 2.0, 1.0][k % 3 + 1]::DOUBLE AS weight,
    [0.5, 0.0, -0.5][k % 3 + 1]::DOUBLE AS tilt FROM s),
o AS (
  SELECT *, (SELECT sum(size) FROM d)::DOUBLE - coalesce(sum(most) OVER (
      ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
l AS (
  SELECT arg_max(rest, weights) AS rest, max(weights) AS weights FROM o WHERE weight * rest <= most * weights),
t AS (
  SELECT o.source, source_size, weight, weight * (1 + tilt) AS w0, weight * (1 - tilt) AS w1,
    CASE WHEN weight * l.rest > most * l.weights THEN most ELSE weight * l.rest / l.weights END AS target
  FROM o, l),
p AS (
  SELECT doc_id, d.source, size, source_size, target, weight, w0, w1, floor(target + 0.5)::BIGINT AS length,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15),
      doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (
  SELECT *, CASE WHEN source_size > 0 THEN length // source_size ELSE 0 END AS whole,
    start::DOUBLE / length AS share FROM p),
y AS (SELECT *, share * weight AS area FROM x)
SELECT doc_id, source, size, source_size, target,
  (whole * size + greatest(0, least(size, length - whole * source_size - start)))::BIGINT AS taken,
  CASE WHEN length = 0 THEN 2 + start::DOUBLE / greatest(source_size, 1) WHEN share >= 1 THEN share
    WHEN area > 0 THEN least(2 * area / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * area)), 1) ELSE 0 END AS position
FROM y"""

# Every distance of every part, round after round.
_ROUND = """
n{0} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.r, v.p, b.e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v JOIN b{0} b USING (p)) GROUP BY r, p)"""
_BOOK = """
m{0} AS (
  SELECT p, e, i, floor(sum(x) / count(*))::BIGINT AS x FROM (
    SELECT v.p, n.e, unnest(range(1, len(v.x) + 1)) AS i, unnest(v.x) AS x FROM v JOIN n{0} n USING (r, p))
  GROUP BY p, e, i),
b{1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{0} b
  LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS x FROM m{0} GROUP BY p, e) m USING (p, e))"""
ORACLES["op12_vector_codes"] = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS r,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT r, p, x[p * (len(x) // 16) + 1:(p + 1) * (len(x) // 16)] AS x FROM k, range(16) t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM v WHERE r <= 64),{_ROUND.format(0)},{_BOOK.format(0, 1)},{_ROUND.format(1)},{
    _BOOK.format(1, 2)},{_ROUND.format(2)},
c AS (SELECT r, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n2 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM k JOIN c USING (r), h"""

# Prices are summed term by term.
ORACLES["op13_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS total FROM t GROUP BY lang, term HAVING count(*) >= 3),
c AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(total)::HUGEINT AS size, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(size, 0)::HUGEINT AS size FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL) USING (lang, source)),
p AS MATERIALIZED (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (g.size + v) AS p,
  1 + (1000000000 * (total + 1)) // (l.size + v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
a AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
  FROM p x JOIN p y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
b AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g x JOIN g y USING (lang) LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  WHERE x.source <> y.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM b QUALIFY part = 'pair' OR rank <= 200"""
