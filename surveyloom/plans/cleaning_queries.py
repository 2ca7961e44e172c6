"""Queries of duplicate rejection and table cleaning (B, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import survey as S
from ..operators import clean as C, dedupe as D
from .derived import RAW_SQL, polls, raw, results, table
from .registry import query
from .text_queries import FINGERPRINT, METHOD, PUBLISH, RANGE_AT, fingerprints, frame_sql


def shorter(spark, d, where: str):
    return table(spark, d, "documents").filter(where).select("doc_id", "text", "lang", "source")


@query("""SELECT doc_id FROM documents n WHERE doc_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM documents k WHERE k.doc_id % 2 = 0 AND k.text IS NOT DISTINCT FROM n.text AND k.lang IS NOT DISTINCT FROM n.lang)""")
def b1_reject_known(spark, d):
    return D.reject_known(shorter(spark, d, "doc_id % 2 = 1"), shorter(spark, d, "doc_id % 2 = 0"), ["text", "lang"]).select("doc_id")


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def b2_first_in_batch(spark, d):
    return D.first_in_batch(table(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest")), ["digest", "lang"], "doc_id").select("doc_id")


@query("""WITH k AS (SELECT CASE WHEN doc_id % 9 > 0 THEN source END AS source, min(doc_id) OVER (PARTITION BY text) = doc_id AS first FROM documents) SELECT source, count(*) AS parsed, count(*) FILTER (first) AS inserted, count(*) FILTER (NOT first) AS skipped FROM k GROUP BY 1""")
def b3_ingest_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 9 > 0, F.col("source")).alias("source"), F.sha2("text", 256).alias("digest"))
    return D.ingest_counts(docs, D.first_in_batch(docs, ["digest"], "doc_id"), "source")


@query("WITH u AS (SELECT user_id, count(*) FILTER (ts >= TIMESTAMP '2024-01-30') AS n FROM events GROUP BY 1) SELECT user_id FROM u WHERE n = 0")
def b4_silent_sources(spark, d):
    e = table(spark, d, "events")
    recent = F.col("ts") >= F.lit("2024-01-30").cast("timestamp")
    runs = e.groupBy("user_id").agg(F.count_if(recent).alias("n"))
    return D.silent_sources(runs, e.filter(~recent), "user_id")


@query("SELECT o_orderkey AS id, 'C' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cleaned_id, 'R' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS raw_id FROM orders")
def b5_public_ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), S.public_id("C", F.col("o_orderkey")).alias("cleaned_id"), S.public_id("R", F.col("o_orderkey")).alias("raw_id"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0")
def d1_unprocessed(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return D.unprocessed(o, o.filter("id % 3 = 0").select(F.col("id").alias("raw_id")), o.filter("id % 5 = 0"))


_PAYLOAD = """CASE id % 4 WHEN 0 THEN to_json(map(party_raw, share_raw)) WHEN 1 THEN '{}' WHEN 2 THEN 'no json' ELSE to_json(map('SPD', '20', party_raw, '5')) END"""
_REJECT = f"""{RAW_SQL.replace('raw AS', 'raw0 AS')}, raw AS (SELECT *, {PUBLISH} AS pub FROM raw0), {frame_sql('frame', 'year(pub)')},
rejected AS (SELECT id, CASE WHEN pub IS NULL THEN 'missing publish date' WHEN f_ignore THEN 'ignored timeframe'
  WHEN id % 4 IN (1, 2) OR (id % 4 = 0 AND NOT (id % 9 IN (0, 1, 2, 3, 6, 7) AND id % 8 IN (0, 1, 3, 5))) THEN 'no party result' WHEN id % 10 = 3 THEN 'duplicate' END AS reason FROM frames)"""


def rejections(spark, d):
    pub = S.publish_date(F.col("publish_raw"))
    rows = raw(spark, d)
    results = C.party_results(C.explode_parties(rows.select("id", F.expr(_PAYLOAD).alias("parties")))).select("id", "results")
    rows = rows.select("id", pub.alias("publish_date"), S.timeframe(F.col("frame"), F.year(pub))["ignore"].alias("ignore")).join(results, "id", "left")
    return C.reject(rows, rows.filter("id % 10 = 3").select("id"))


@query(f"WITH {_REJECT} SELECT id, reason FROM rejected")
def d2_rejections(spark, d):
    return rejections(spark, d).select("id", "reason")


@query(f"""WITH {RAW_SQL} SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN DATE '2001-01-01' END, {RANGE_AT(1)}) AS survey_start, {RANGE_AT(2)} AS survey_end, coalesce({METHOD}, CASE id % 2 WHEN 0 THEN 'TELEFONISCH' ELSE 'UNBEKANNT' END) AS method,
  coalesce(nullif(trim(institute_raw), ''), 'Unknown') AS provider FROM raw""")
def d3_fallbacks(spark, d):
    none = F.lit(None).cast("date")
    rows = raw(spark, d).select(
        "id", S.publish_date(F.col("publish_raw")).alias("publish_date"), F.when(F.col("id") % 3 == 0, F.lit("2001-01-01").cast("date")).alias("survey_start"), none.alias("survey_end"),
        F.col("respondents_raw").alias("respondents_text"), F.when(F.col("id") % 2 == 0, "CATI").otherwise("99").alias("method_text"), F.col("institute_raw").alias("provider"),
    )
    return C.with_fallbacks(rows).select("id", "survey_start", "survey_end", "method", "provider")


@query("""WITH dim AS (SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS id, 'src' || s_nationkey AS source FROM supplier WHERE s_nationkey < 5), unseen AS (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT source FROM dim))
SELECT * FROM dim UNION ALL SELECT (SELECT max(id) FROM dim) + row_number() OVER (ORDER BY source), source FROM unseen""")
def d4_new_members(spark, d):
    dim = table(spark, d, "supplier").filter("s_nationkey < 5").select(F.col("s_nationkey").cast("long").alias("id"), F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("source")).distinct()
    return D.new_members(table(spark, d, "documents"), dim, "source")


def digests(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 11 > 0, F.sha2(F.lower("text"), 256)).alias("fingerprint"))


@query("SELECT doc_id AS id, first AS duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY lower(text)) AS first FROM documents WHERE doc_id % 11 > 0) WHERE first <> doc_id")
def d5_fingerprint_duplicates(spark, d):
    rows = digests(spark, d)
    stored = rows.filter("id < 100")
    stored_first = stored.groupBy("fingerprint").agg(F.min("id").alias("id"))
    kept, dups = D.first_by_fingerprint(rows.filter("id >= 100"), stored_first)
    within = stored.join(stored_first.withColumnRenamed("id", "duplicate_of"), "fingerprint").filter("id <> duplicate_of").select("id", "duplicate_of")
    return dups.unionByName(within)


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS version FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def d6_upsert(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return D.upsert(o.filter("id % 2 = 0").withColumn("version", F.lit("old")), o.filter("id % 3 = 0").withColumn("version", F.lit("new")), "id")


@query("""WITH r AS (SELECT l_orderkey AS poll_id, CAST(l_linenumber AS VARCHAR) AS party, max(l_quantity) AS percentage FROM lineitem GROUP BY 1, 2) SELECT * FROM r WHERE poll_id % 4 <> 0 UNION ALL SELECT poll_id, party, percentage + 1 FROM r WHERE poll_id % 4 = 0 AND party <> '7'""")
def d7_sync_results(spark, d):
    r = results(spark, d)
    new = r.filter("poll_id % 4 = 0 and party <> '7'").withColumn("percentage", F.col("percentage") + 1)
    return D.sync_children(r, new, r.filter("poll_id % 4 = 0"), "poll_id")


@query("""WITH f AS (SELECT doc_id AS id, sha256(text) AS made FROM documents), s AS (SELECT id, made, CASE WHEN id % 2 = 0 THEN made END AS fingerprint FROM f),
o AS (SELECT id, made, row_number() OVER (PARTITION BY made ORDER BY id) AS n FROM s WHERE fingerprint IS NULL)
SELECT s.id, coalesce(s.fingerprint, CASE WHEN o.n = 1 AND NOT EXISTS (SELECT 1 FROM s u WHERE u.fingerprint = o.made) THEN o.made END) AS fingerprint FROM s LEFT JOIN o ON o.id = s.id""")
def d8_backfill(spark, d):
    made = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("fingerprint"))
    return D.backfill(made.withColumn("fingerprint", F.when(F.col("id") % 2 == 0, F.col("fingerprint"))), made)


@query(f"""WITH {_REJECT}, m AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'matched' WHEN 1 THEN 'multiple_matches' ELSE 'no_match' END AS status FROM orders WHERE o_orderkey % 3 = 0)
SELECT count(*) AS processed, count(*) FILTER (reason IS NULL AND id % 7 <> 0) AS created, count(*) FILTER (reason IS NULL AND id % 7 = 0) AS updated, count(*) FILTER (reason IS NOT NULL) AS skipped,
(SELECT count(*) FILTER (status = 'matched') FROM m) AS matched, (SELECT count(*) FILTER (status = 'multiple_matches') FROM m) AS ambiguous,
(SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS public, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'O') AS excluded FROM rejected""")
def d10_cleaning_statistics(spark, d):
    k = F.col("o_orderkey")
    links = table(spark, d, "orders").select(F.when(k % 3 == 0, "primary").otherwise("secondary").alias("side"), F.when(k % 4 == 0, "matched").when(k % 4 == 1, "multiple_matches").otherwise("no_match").alias("status"))
    return C.cleaning_statistics(rejections(spark, d).withColumn("existed", F.col("id") % 7 == 0), links, table(spark, d, "orders").select((F.col("o_orderstatus") == "O").alias("is_public")))


@query(f"WITH {FINGERPRINT} SELECT id, CAST(count(*) OVER (PARTITION BY fingerprint) AS BIGINT) AS copies FROM fp WHERE fingerprint IS NOT NULL")
def d5_poll_copies(spark, d):
    rows = fingerprints(polls(spark, d), results(spark, d)).select("id", "fingerprint").filter("fingerprint is not null")
    return rows.join(rows.groupBy("fingerprint").agg(F.count("*").alias("copies")), "fingerprint").select("id", "copies")


@query("""SELECT 'incremental' AS mode, o_orderkey AS id, o_orderkey % 3 = 0 AS has_poll FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0
UNION ALL SELECT 'reprocess', o_orderkey, o_orderkey % 3 = 0 FROM orders UNION ALL SELECT 'rebuild', o_orderkey, false FROM orders""")
def d9_run_modes(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    known, copies, out = o.filter("id % 3 = 0").select(F.col("id").alias("raw_id")), o.filter("id % 5 = 0"), None
    for mode in D.MODES:
        rows, before = D.select_run(o, known, copies, mode)
        run = rows.join(before, F.col("id") == F.col("raw_id"), "left").select(F.lit(mode).alias("mode"), "id", F.col("raw_id").isNotNull().alias("has_poll"))
        out = run if out is None else out.unionByName(run)
    return out
