"""Queries over the driver's tables, one for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import chat_trees, decontaminate, hard_negatives, kd_sharding, language_id, lattice_lm, near_dedup, ogg_media, periodic_runs, repeat_removal, subword, toxicity, word_bpe
from tidewright.llm.common import in_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = docs.where(~in_fold(5, 0) & F.col("doc_id").isNotNull())
    return language_id.detect_language(docs, learn).select("doc_id", in_fold(5, 0).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query
def op6_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg_media.text_to_media(table(spark, sf_dir, "documents"))


@query
def op10_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    paths = chat_trees.best_paths(chat_trees.threads(rows))
    return chat_trees.digest_formatted(chat_trees.format_paths(paths)).withColumnRenamed("tree", "conv_id")


ORACLES["op10_chat_trees"] = r"""
WITH r AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
         len(regexp_extract_all(text, '\\|<\|start\|>|<\|message\|>|<\|end\|>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS marks FROM r
), c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '') AS loss,
         sum(length('<|start|><|message|><|end|>') + length(role) + length(text) + marks) AS formatted FROM t GROUP BY 1
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars FROM c
"""


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~in_fold(3, 1)))
    return toxicity.score_toxicity(docs, model).withColumn("held_out", in_fold(3, 1))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest_hits(decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


ORACLES["op3_decontaminate"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM win
), place AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, sizes WHERE len(w) >= k)
), hit AS (SELECT p.doc_id, p.i, p.k, win.item_id FROM place p JOIN win ON p.k = win.k AND p.s = win.s
), word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY 1
), found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op5_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.encode_texts(table(spark, sf_dir, "documents"))


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.NearDup(words=2))


ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) > 1 THEN w[i] || ' ' || w[i + 1] ELSE w[1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1
), sized AS (SELECT shingle.*, n FROM shingle JOIN size USING (doc_id)
), link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), walk(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT walk.x, edge.y FROM walk JOIN edge ON walk.y = edge.x
), component AS (SELECT x AS doc_id, min(y) AS c FROM walk GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept FROM documents JOIN component USING (doc_id) LEFT JOIN size USING (doc_id)
"""


@query
def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {c: kd_sharding.category(c) for c in ("lang", "source")}
    placed = kd_sharding.kd_shards(table(spark, sf_dir, "documents"), dims, n_shards=16)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int"), "shard": F.col("shard").cast("int"), "slot": F.col("slot").cast("long")})


@query
def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lattice_lm.score_texts(docs, ~in_fold(10, 0) & F.col("doc_id").isNotNull()).withColumn("held_out", in_fold(10, 0))


@query
def op9_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_removal.digest_repeats(repeat_removal.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


ORACLES["op9_repeat_removal"] = """
WITH doc AS (
  SELECT doc_id, encode(coalesce(text, '')) AS raw, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), place AS (
  SELECT doc_id, i, raw[i + 1:i + 50] AS s FROM (SELECT doc_id, raw, unnest(range(0, n - 49)) AS i FROM doc WHERE n >= 50)
), first AS (SELECT s, min(doc_id) AS least FROM place GROUP BY 1 HAVING count(*) > 1
), hit AS (SELECT doc_id, i FROM place JOIN first USING (s) WHERE least < doc_id
), marked AS (SELECT doc_id, i, coalesce(i - lag(i) OVER w > 50, true) AS new FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked
), span AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY 1, 2
), cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM span
), part AS (
  SELECT doc_id, string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS head, max(b) AS last, sum(b - a) AS removed, count(*) AS spans
  FROM cut JOIN doc USING (doc_id) GROUP BY 1
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM doc LEFT JOIN part USING (doc_id)
"""


@query
def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.digest_tokens(word_bpe.decode_tokens(word_bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), label.alias("label"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose crc32 is divisible by ten repeat a part of themselves from word a on, with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.split_words(F.col("text")).alias("words"), h.alias("h"), F.floor(h / 10).alias("g"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.expr("g % nullif(n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("transform(sequence(0L, n - 1L), i -> words[int(if(i >= a, a + (i - a) % p, i))])")
    words = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("words"))
    return periodic_runs.digest_runs(periodic_runs.find_runs(docs.select("doc_id", words.alias("words")), F.col("words")).select("doc_id", "runs", "collapsed"))
