"""The queries of this subpackage: each operator on its whole table, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm import (
    centroids, chat, decontaminate, exact, importance, lengths, orc_tokens, packing, paragraphs, quality, sharding, simhash, toxicity,
)
from landfall.llm.base import fold, small_batches, table


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), "source", "lang", "n_chars"
    )
    placed = sharding.shard(rows, ["source", "lang", "n_chars"], ["doc_id", "text_crc32", "size"], 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op2_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, with_ids=False).drop("token_ids")


def op4_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated(table(spark, sf_dir, "documents")).drop("text_key")


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored, score = toxicity.with_toxicity(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))
    return _scores(scored, score, fold(F.col("doc_id"), 5) == 0, 0.5)


def op6_bloom_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, mark = exact.mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return marked.select("doc_id", f"{mark}.*")


def op7_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = orc_tokens.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.digests(orc_tokens.read_tokens(spark, path))


def op8_aligned_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op9_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.limits(lengths.histogram(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op10_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored, score = quality.with_quality(docs, quality.learn_quality(docs, table(spark, sf_dir, "labels")))
    return _scores(scored, score, fold(F.col("doc_id"), 4) == 2, 0.7)


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: A conversation of its own beside the given ones, that says what the template writes itself.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op13_reply_tree_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    # A conversation is a tree without branches: every row answers the one before it.
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    replies = rows.withColumn("node", place).withColumn("parent", F.col("node") - 1)
    path = chat.write_conversations(replies, tree="conv_id")
    read = chat.read_conversations(spark, path)
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length(F.col("formatted").cast("string")).cast("long").alias("formatted_chars"),
    )


def _scores(scored: DataFrame, score: str, held_out, least: float) -> DataFrame:
    rows = scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(score).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


def _in_small_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _in_small_batches(f)
    for f in (
        op1_hilbert_shards, op2_covering_simhash, op3_curve_packing, op4_paragraph_minhash, op5_counterfactual_toxicity,
        op6_bloom_exact, op7_orc_tokens, op8_aligned_leaks, op9_length_histogram, op10_ftrl_quality, op11_pivot_clusters, op12_importance_resampling,
        op13_reply_tree_chats,
    )
}



def _rounds(count: int) -> str:
    """Assignments a0 to a<count> and the centroids c1 to c<count> between them."""
    steps = []
    for k in range(count + 1):
        steps.append(f"""
        a{k} AS MATERIALIZED (
            SELECT rid, min({{'d': d, 'c': c}}) AS best FROM (
                SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d FROM parts JOIN c{k} USING (i) GROUP BY rid, c
            ) GROUP BY rid
        )""")
        if k < count:
            steps.append(f"""
        c{k + 1} AS MATERIALIZED (
            SELECT c, i, coalesce(mean, y) AS y FROM c{k} LEFT JOIN (
                SELECT best.c AS c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
                FROM parts JOIN a{k} USING (rid) GROUP BY best.c, i
            ) USING (c, i)
        )""")
    return ",".join(steps)


#: The lower-cased words of a text, its runs of one to three words, and crc32 by bytes with a table made from the polynomial.
_FEATURES = r"""
        crcs AS MATERIALIZED (
            SELECT list(c ORDER BY n) AS t FROM (
                SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
                FROM range(256) r(n)
            )
        ), words AS (
            SELECT 'd' AS side, row_number() OVER () AS rid, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
            UNION ALL
            SELECT 'b', row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
        ), sized AS MATERIALIZED (SELECT *, len(w) AS n FROM words),
        runs AS MATERIALIZED (
            SELECT side, rid, f, count(*) AS n FROM (
                SELECT side, rid, unnest(w || list_transform(range(1, n), lambda k: w[k] || ' ' || w[k + 1])
                    || list_transform(range(1, n - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS f FROM sized
            ) GROUP BY ALL
        ), hexed AS (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM runs)),
        hashed AS MATERIALIZED (
            SELECT f, xor(4294967295, list_reduce(
                [4294967295::BIGINT] || list_transform(range(0, len(h) // 2), lambda k: ('0x' || h[2 * k + 1 : 2 * k + 2])::BIGINT),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
            )) % 10000 AS bucket FROM hexed, crcs
        ), met AS MATERIALIZED (SELECT side, rid, bucket, sum(runs.n)::BIGINT AS n FROM runs JOIN hashed USING (f) GROUP BY ALL)"""

ORACLES = {
    "op11_pivot_clusters": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), parts AS MATERIALIZED (SELECT rid, unnest(range(64)) AS i, unnest(v) AS x FROM kept),
        c0 AS MATERIALIZED (
            SELECT c, unnest(range(64)) AS i, unnest(v) AS y FROM (
                SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept
            ) WHERE c < 40
        ), {_rounds(5)},
        names AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c),
        placed AS (SELECT vec_id, best.c AS c, best.d AS d FROM kept JOIN a5 USING (rid))
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256 FROM placed JOIN names USING (c)
    """,
    "op12_importance_resampling": f"""
        WITH {_FEATURES},
        sums AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM met GROUP BY bucket),
        whole AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM sums, whole
        ), weights AS (
            SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM met JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid
        ), scored AS (
            SELECT id AS doc_id, n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM sized LEFT JOIN weights USING (rid) WHERE side = 'd'
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n >= 20) OVER () AS fit FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n >= 20 AND place <= 5 * fit // 100 THEN place END AS rank FROM ranked
    """,
    "op13_reply_tree_chats": r"""
        WITH m AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        ), e AS (
            SELECT *, 14 + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t'))
                + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')) AS written FROM m
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(written)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op6_bloom_exact": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
    """,
}
