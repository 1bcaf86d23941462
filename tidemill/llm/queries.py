"""Registered queries of the text operators, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    centroids, decontamination, filter_audit, jaccard_join, lattice_scoring, licences, neighbours, packing, quality_classifier,
    quality_rules, secrets, sharding, token_counts,
)
from tidemill.llm.tokens import public_path
from tidemill.llm.workers import share_package

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return share_package(spark).read.parquet(f"{folder}/documents.parquet")


def remainder(n: int) -> Column:
    """The CRC-32 of an id's text modulo ``n``; of a null id, of the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text").withColumn("held_out", remainder(3) == 1)
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(remainder(3) != 1)
    chosen = quality_classifier.sample_labels(labels, "quality")
    labelled = docs.join(F.broadcast(chosen), "doc_id")
    model = quality_classifier.fit_classifier(labelled)
    return quality_classifier.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, folder).select("doc_id"), SHARDS)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    judged = quality_rules.apply_rules(docs, carry=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "log_perplexity", "lower", "upper",
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return decontamination.find_items(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def op5_lattice_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return lattice_scoring.score_documents(docs, remainder(7) == 2, public_path("piece_bpe_32k.model"))


def _spans_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = secrets.find_secrets(docs, carry=["doc_id"])
    counts = [_spans_of(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    digest = F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.as_text(F.col("spans")).alias("spans"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    packed = packing.pack_documents(docs, public_path("byte_bpe_50k.json"), digest=True)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return jaccard_join.link_documents(docs, size=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents lie in a folder of their language inside that of their source."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    docs = documents(spark, folder).select("doc_id", path.alias("path"), "text")
    return licences.scan_licences(docs).select("doc_id", "path", "license", "similarity", "how", "from_dir")


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = share_package(spark).read.parquet(f"{folder}/embeddings.parquet")
    return centroids.cluster(embeddings, k=40, rounds=5, width=64, scale=256, salt="2:")


def op12_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = share_package(spark).read.parquet(f"{folder}/embeddings.parquet")
    index, pivots = neighbours.build_index(embeddings, width=64)
    return neighbours.search(index, pivots, F.col("vec_id") % 100 == 0, k=10)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    return filter_audit.audit(filter_audit.document_masks(docs), spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_sharding, op3_quality_rules, op4_decontamination, op5_lattice_scoring, op6_secrets,
    op7_packing, op8_jaccard_join, op9_token_counts, op10_licences, op11_centroids, op12_neighbours, op13_filter_audit,
)}

def _rounds_sql(k: int, rounds: int, width: int) -> str:
    """Clustering as one common table expression for each assignment ``a`` and each set of centroids ``c``."""
    parts = [f"""
        kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
        v AS MATERIALIZED (SELECT vec_id, i, v[i] AS x FROM kept, range(1, {width + 1}) r(i)),
        c0 AS MATERIALIZED (
            SELECT k, i, x FROM (SELECT vec_id, CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS k FROM kept) JOIN v USING (vec_id) WHERE k < {k})"""]
    for n in range(rounds + 1):
        parts.append(f"""
        a{n} AS MATERIALIZED (
            SELECT vec_id, k, d FROM (SELECT vec_id, k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{n} c USING (i) GROUP BY vec_id, k)
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if n < rounds:
            parts.append(f"""
        m{n} AS (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{n} JOIN v USING (vec_id) GROUP BY k, i),
        c{n + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (k, i))""")
    return "WITH " + ",".join(parts) + f"""
        SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k) USING (k)"""


_AUDIT_SQL = """
    WITH words AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    fails AS (
        SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
               100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
               coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
        FROM words),
    known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    rows AS (
        SELECT part, [a, b, c, d, e] AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
        FROM fails LEFT JOIN known USING (doc_id)),
    counts AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rows GROUP BY part, f),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
        WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
    steps AS (
        SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS letter, instr('ABCDE', substr(filter_order, i, 1)) AS own,
               list_transform(range(1, i), lambda j: instr('ABCDE', substr(filter_order, j, 1))) AS before
        FROM orders, range(1, 6) r(i)),
    flags AS (
        SELECT part, filter_order, step, letter, n, good, toxic, f[own] AS failing, len(list_filter(before, lambda j: f[j])) = 0 AS reached,
               len(list_filter(f, lambda x: x)) = 1 AS single
        FROM counts, steps),
    report AS (
        SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (reached AND NOT failing), 0) AS kept,
               coalesce(sum(n) FILTER (reached AND failing), 0) AS removed, coalesce(sum(n) FILTER (NOT reached AND failing), 0) AS redundant,
               coalesce(sum(n) FILTER (failing AND single), 0) AS unique_fails, coalesce(sum(good) FILTER (reached AND failing), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (reached AND failing), 0) AS toxic_lost
        FROM flags GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM report
"""

ORACLES: dict[str, str] = {
    "op11_centroids": _rounds_sql(40, 5, 64),
    "op13_filter_audit": _AUDIT_SQL,
    "op2_sharding": """
        SELECT doc_id, slot, t.shard
        FROM (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {slots} AS INTEGER) AS slot
              FROM documents)
        JOIN (SELECT CAST(i - 1 AS INTEGER) AS slot, 'shard-' || lpad(CAST(shards[i] AS VARCHAR), 3, '0') AS shard
              FROM (SELECT {table} AS shards), range(1, {slots} + 1) r(i)) t USING (slot)
    """.format(slots=sharding.SLOTS, table=list(sharding.lookup_table(SHARDS))),
}
