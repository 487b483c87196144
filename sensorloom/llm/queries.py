"""The corpus operators as ready-made queries over the given tables, and their check SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import ann, bpe, chat_quotes, exact_dedup, hard_negatives, packing, pii, recurrent, simhash, substring, toxicity, warc, whitening
from sensorloom.llm.common import numbered, table
from sensorloom.sources.staging import staging_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(build):
        QUERIES[name] = build
        if check:
            CHECKS[name] = check
        return build

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pack_multiway")
def op1_pack_multiway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_exact_radix", r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
         r AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                      row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS nth,
                      first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id FROM n)
    SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM r""")
def op7_exact_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    rows = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return exact_dedup.exact_duplicates(rows).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@query("op8_simhash_trie")
def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: fingerprints linked at two or fewer differing bits."""
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query("op3_ann_one_bit", """
    WITH fine AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
         pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
                   FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM pairs)
    SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM ranked WHERE nth <= 20""")
def op3_ann_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest neighbours of every twentieth vector among all vectors."""
    rows = ann.clean(table(spark, sf_dir, "embeddings"))
    return ann.search(ann.build_index(rows), rows.where("id % 20 = 0"), k=20)


@query("op4_bpe_distinct_words")
def op4_bpe_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return done.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_warc_segments", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
         r AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes,
                      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
                          (CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - i % 4 * 5)) & 31) AS INTEGER), 1)),
                          'string_agg', '') AS payload_digest,
                      max(page_id) OVER (PARTITION BY html) AS last FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, CAST(NULL AS VARCHAR) AS problem FROM r""")
def op10_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    path = f"{staging_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_index(spark, path).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "problem")


@query("op5_toxicity_nnpu")
def op5_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@query("op6_pii_bootstrap")
def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and those that their contexts lead to."""
    rows = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    report = pii.span_report(rows.select("row", "doc_id"), pii.personal_spans(rows))
    return report.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op9_compact_windows")
def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat across all documents."""
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@query("op2_chat_quotes", """
    WITH m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS nth FROM conversations)
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
           lag(turn) OVER w AS reply_to, CASE WHEN nth > 0 THEN 'turn' END AS link, first_value(turn) OVER w AS thread,
           CAST(nth AS INTEGER) AS depth, CAST(0 AS BIGINT) AS quotes, coalesce(text, '') AS content,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS chat
    FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
    -- Holds while no text quotes another; what quoting does is tested against a plain program.
""")
def op2_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order without quoted passages."""
    return chat_quotes.conversations(table(spark, sf_dir, "conversations"))


@query("op11_hyperplane_negatives", """
    WITH fine AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
                  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
         pairs AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
                          CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
                   FROM fine a JOIN fine c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
         pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS nth FROM pairs WHERE same)
                 WHERE nth <= 5),
         neg AS (SELECT p.anchor_id, p.other AS positive_id, p.score AS positive_score, n.other AS negative_id, n.score AS negative_score,
                        row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS nth
                 FROM pos p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
                  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE nth <= 3""")
def op11_hyperplane_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each positive of every fiftieth vector among all vectors."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query("op12_rank_one_whitening")
def op12_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 16 whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op13_recurrent_scores")
def op13_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document under a recurrent model and under counts."""
    return recurrent.log_likelihoods(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
