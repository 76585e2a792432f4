"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettera.llm import (
    decontaminate, filter_audit, html_text, licenses, mixture, near_duplicates, packing, periods, quality,
    sanitise, sharding, urls, warc,
)
from lettera.llm.common import let, table, text_of

#: A shard's bytes at most, and how many shards a smaller table gets at least, to be read at once.
SHARD_BYTES, LEAST_SHARDS = 64 << 20, 16


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sanitise.marked_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    terms = F.transform("terms", lambda t: F.struct(
        F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")
    ))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        *(
            F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
            for kind in sanitise.KINDS
        ),
        F.sha2(sanitise.listed(base), 256).alias("base_sha256"),
        F.concat_ws(",", *(
            F.when(F.size(c) > 0, sanitise.listed(c)) for c in (F.col("spans"), terms)
        )).alias("spans"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("row.doc_id", *(f"s.{n}" for n in names), "base_failed", "kept")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).drop(
        "text_key", "class_key"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(text_of()).alias("size"))
    total = docs.agg(F.sum("size")).first()[0] or 0
    limit = min(SHARD_BYTES, max(1, total // LEAST_SHARDS))
    shards = sharding.assign_shards(docs, F.col("doc_id"), F.col("size"), limit)
    return shards.select("row.doc_id", "bytes", "shard", "depth", "shard_bytes", "oversized")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which about one document in ten has a repeating end.

    The digits of crc32 of the decimal id tell whether, from which word and with which period.
    """
    words = F.filter(F.split(text_of(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def repeated(w):
        n = F.size(w).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(
            F.sequence(a, n - 1), lambda i: F.element_at(w, (1 + a + (i - a) % period).cast("int"))
        )
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " "))

    return docs.select(
        "doc_id", F.when(hashed % 10 == 0, let(words, repeated)).otherwise(text_of()).alias("text")
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periods.with_runs(with_planted_runs(table(spark, sf_dir, "documents")))

    def by_exponent(x, y):
        mine, other = x["length"] * y["period"], y["length"] * x["period"]
        first = F.coalesce(
            *(F.when(p != q, F.when(p < q, -1).otherwise(1)) for p, q in (
                (other, mine), (x["start"], y["start"]), (x["period"], y["period"])
            )), F.lit(0)
        )
        return first.cast("int")

    best = F.get(F.array_sort("runs", by_exponent), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in (
        "start", "length", "period"
    ))), F.lit("\n")))
    return rows.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = filter_audit.text_verdicts(table(spark, sf_dir, "documents"))
    labelled = filter_audit.with_labels(verdicts, table(spark, sf_dir, "labels"))
    return filter_audit.audited(
        labelled, "part", "ABCDE", {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_license_scan, op3_best_fit_packing, op4_pii, op5_decontamination,
        op6_quality_rules, op7_ngram_jaccard_join, op8_url_filter, op9_sharding, op10_warc,
        op11_periodic_runs, op12_mixture_packing, op13_filter_audit,
    )
}

#: A bucket's depth is the least at which its bytes fit the limit; a lone row is a bucket.
ORACLE: dict[str, str] = {
    "op9_sharding": f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         right(lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0'), 60) AS h
  FROM documents
), l AS (
  SELECT least({SHARD_BYTES}, greatest(1, sum(bytes) // {LEAST_SHARDS})) AS most FROM d
), p AS (
  SELECT d.*, g.depth, left(h, g.depth) AS shard FROM d, (SELECT unnest(range(0, 61)) AS depth) g
), b AS (
  SELECT depth, shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS n FROM p GROUP BY depth, shard
)
SELECT doc_id, bytes, p.shard, p.depth::INT AS depth, shard_bytes, shard_bytes > most AS oversized
FROM l, p JOIN b ON p.depth = b.depth AND p.shard = b.shard
WHERE b.shard_bytes <= most OR b.n = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p.depth) = 1
""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
""",
    "op13_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), f AS (
  SELECT doc_id, part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM w
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), n AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS code,
         count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2
), s AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM s a, s b, s c, s d, s e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, k::INT AS step, bits[k] AS own, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before
  FROM orders, range(1, 6) AS r(k)
), x AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (code & (before | own) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (code & before = 0 AND code & own <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (code & before <> 0 AND code & own <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (code = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (code & before = 0 AND code & own <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (code & before = 0 AND code & own <> 0), 0) AS toxic_lost
  FROM steps, n GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM x
""",
}
