"""One registered query per operator over its whole table, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import exact_dedup as dedup
from . import alignment, bpe_automaton, fim, jaccard_join, language_id, mixing, packing, pii, sharding, token_files, topk, warc


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.exact_dedup(docs, digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.in_training_order(mixing.mix_plan(docs)).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.write_token_files(docs, vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_warc(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(*kinds):
        return F.filter("pii", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(joined(of(*pii.BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.jaccard_components(docs, words=4, percent=85)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = vocabulary("word_bpe_49k.json")
    return bpe_automaton.decode(bpe_automaton.encode(docs, words), words).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fim.fill_in_middle(docs, seed=7, transform=100, spm=50)
    own = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return fim.restored(out, keep=own).select(*own, "restored_sha256")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digest=True).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_token_files": op4_token_files,
    "op5_language_id": op5_language_id,
    "op6_warc": op6_warc,
    "op7_pii": op7_pii,
    "op8_sharding": op8_sharding,
    "op9_topk": op9_topk,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_bpe": op11_bpe,
    "op12_fim": op12_fim,
    "op13_alignment": op13_alignment,
}

SQL = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op3_mixing": r"""
        WITH d AS (
          SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
                 coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
          FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (
          SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM s),
        w AS (SELECT *, rnk % 3 + 1 AS w, source_size * 3 AS cap FROM r),
        l AS (
          SELECT *, (sum(source_size) OVER ()::DOUBLE
                     - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, rnk
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                    / sum(w) OVER (ORDER BY cap::DOUBLE / w, rnk
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lvl
          FROM w),
        t AS (SELECT source, source_size, rnk, least(cap::DOUBLE, max(lvl) OVER () * w) AS target FROM l),
        o AS (
          SELECT d.doc_id, d.size, t.source_size, t.target,
                 coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                 CAST(round(t.target) AS BIGINT) AS goal, t.rnk
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        p AS (SELECT *, CASE WHEN least(size, goal - start) > 0 THEN least(1.0, start / target) END AS u FROM o)
        SELECT doc_id, size, source_size, target,
               -- the integrated schedules (densities 1.5 to 0.5; 1; 0.5 and, from the middle, to 2) inverted
               CASE WHEN u IS NOT NULL THEN CASE rnk % 3
                 WHEN 0 THEN least(1.0, 2 * u / (1.5 + sqrt(greatest(0, 2.25 - 2 * u))))
                 WHEN 1 THEN u
                 ELSE CASE WHEN 0.875 * u < 0.25 THEN least(0.5, 2 * 0.875 * u)
                           ELSE least(1.0, 0.5 + 2 * (0.875 * u - 0.25) / (0.5 + sqrt(greatest(0, 0.25 + 6 * (0.875 * u - 0.25))))) END
               END END AS position,
               CAST(greatest(0, least(size, goal - start))
                  + greatest(0, least(size, goal - start - source_size))
                  + greatest(0, least(size, goal - start - 2 * source_size)) AS BIGINT) AS taken
        FROM p""",
    "op6_warc": """
        WITH p AS (
          SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
                 CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
          FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM g""",
    "op9_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        r AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_fim": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                 regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
          FROM documents),
        k AS (
          SELECT *, CAST(len(u) AS BIGINT) AS n,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
                 CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
          FROM d),
        c AS (
          SELECT *, array_to_string(u[1:least(x, y)], '') AS pre, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid,
                 array_to_string(u[greatest(x, y) + 1:], '') AS suf,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                      THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM k)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c""",
}
