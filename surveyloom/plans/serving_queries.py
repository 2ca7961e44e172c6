"""Queries of the serving views (H)."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..operators import select as P, validate as V, views as H
from ..sources.layout import laid_out
from .derived import POLL, RESULT, polls, results, table
from .registry import query
from .validation_queries import QUALITY, validations

BASE = f"{POLL}, {RESULT}"


#: Polls with scope codes, provider ids, raw and matched ids, public or not.
SERVED = f"""{POLL}, served AS (SELECT poll.* REPLACE (CASE scope % 4 WHEN 0 THEN 'federal' WHEN 1 THEN 'by' WHEN 2 THEN 'nrw' ELSE 'th' END AS scope), scope % 7 AS provider_id, id + 5 AS raw_id, CASE WHEN id % 3 = 0 THEN id + 1 END AS matching_poll_id,
  id % 5 <> 0 AS is_public, 'P' || institute AS institute_key FROM poll),
checked AS (SELECT id AS poll_id, id % 4 <> 1 AS valid FROM poll WHERE id % 3 <> 0),
gated AS (SELECT served.* FROM served LEFT JOIN checked ON poll_id = id WHERE is_public AND (coalesce(valid, false) OR (provider = 'historic' AND year(publish_date) < 1998)))"""
GATE = P.GatePolicy(cutoff_year=1998)


def served(spark, d):
    code = F.when(F.col("scope") % 4 == 0, "federal").when(F.col("scope") % 4 == 1, "by").when(F.col("scope") % 4 == 2, "nrw").otherwise("th")
    return polls(spark, d).withColumns(
        {
            "scope": code, "provider_id": F.col("scope") % 7, "raw_id": F.col("id") + 5, "matching_poll_id": F.when(F.col("id") % 3 == 0, F.col("id") + 1), "is_public": F.col("id") % 5 != 0,
            "institute_key": F.concat(F.lit("P"), F.col("institute").cast("string")),
        }
    )


def checked(spark, d):
    return polls(spark, d).filter("id % 3 <> 0").select(F.col("id").alias("poll_id"), (F.col("id") % 4 != 1).alias("valid"), F.lit(0).alias("warning_count"))


FILTERS = {"scopes": ["Bund", "Bayern", "NRW"], "institutes": [" p0", "P1 ", "P2", "p4"], "elections": ["e0"], "methods": [" 1-urgent ", "5-LOW", "2-high"], "provider": "Primary", "source": "s1", "date_from": "1995-06-01", "date_to": "2000-12-31"}
FILTERED = """scope IN ('federal', 'by', 'nrw') AND institute_key IN ('P0', 'P1', 'P2', 'P4') AND election = 'E0' AND method IN ('1-URGENT', '5-LOW', '2-HIGH') AND provider = 'primary' AND source = 's1' AND publish_date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31'"""


def by_key(rows):
    return rows.withColumn("institute", F.col("institute_key"))


@query(f"WITH {SERVED} SELECT id FROM served WHERE {FILTERED} UNION ALL SELECT -id FROM served WHERE provider_id = 3")
def h1_poll_filters(spark, d):
    rows = by_key(served(spark, d))
    return H.filter_polls(rows, **FILTERS).select("id").unionByName(H.filter_polls(rows, provider_id=3, scopes=[]).select((-F.col("id")).alias("id")))


@query(f"WITH {POLL} SELECT id, row_number() OVER (PARTITION BY scope ORDER BY publish_date DESC, id DESC) AS place FROM poll")
def h3_sorted(spark, d):
    place = F.row_number().over(W.partitionBy("scope").orderBy(F.desc("publish_date"), F.desc("id"))).cast("long")
    return H.sort_polls(polls(spark, d)).select("id", place.alias("place"))


@query(f"WITH {POLL} SELECT id, row_number() OVER (ORDER BY publish_date DESC, id DESC) AS place, count(*) OVER () AS total, count(*) OVER () > 60 AS has_next FROM poll QUALIFY place BETWEEN 41 AND 60")
def h4_page(spark, d):
    return H.page(polls(spark, d), 40, 20).select("id", F.col("place").cast("long").alias("place"), "total", "has_next")


ENRICHED = f"""{SERVED}, named AS (SELECT p.id, 'C' || lpad(CAST(p.id AS VARCHAR), 8, '0') AS public_id, CASE WHEN r.o_orderkey IS NOT NULL THEN 'R' || lpad(CAST(p.raw_id AS VARCHAR), 8, '0') END AS raw_public_id,
  s_name AS institute_name, r_name AS provider_name, lower(p.method) AS method_name, lower(p.election) AS election, CASE p.election WHEN 'E0' THEN 'Federal election' WHEN 'E1' THEN 'State election' END AS election_type,
  CASE WHEN m.id IS NOT NULL THEN 'C' || lpad(CAST(p.matching_poll_id AS VARCHAR), 8, '0') END AS matching_poll_public_id, p.publish_date, p.provider
  FROM served p LEFT JOIN orders r ON r.o_orderkey = p.raw_id LEFT JOIN supplier ON s_suppkey = p.institute LEFT JOIN region ON r_regionkey = p.provider_id LEFT JOIN poll m ON m.id = p.matching_poll_id)"""


def enriched(spark, d):
    orders = table(spark, d, "orders")
    elections = table(spark, d, "nation").filter("n_nationkey < 2").select(F.concat(F.lit("E"), F.col("n_nationkey").cast("string")).alias("key"), F.when(F.col("n_nationkey") == 0, "Bundestagswahl").otherwise("Landtagswahl").alias("type"))
    return H.enriched(
        served(spark, d), orders.select(F.col("o_orderkey").alias("id")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        elections, orders.select(F.col("o_orderpriority").alias("key"), F.lower("o_orderpriority").alias("name")).distinct(),
    )


@query(f"WITH {ENRICHED} SELECT * EXCLUDE (publish_date, provider) FROM named")
def h5_enriched(spark, d):
    return enriched(spark, d).select("id", "public_id", "raw_public_id", "institute_name", "provider_name", "method_name", "election", "election_type", "matching_poll_public_id")


@query(f"WITH {BASE} SELECT poll_id, string_agg(party || '=' || CAST(CAST(percentage AS INT) AS VARCHAR), ',' ORDER BY party) AS results FROM result GROUP BY 1")
def h6_nested_results(spark, d):
    text = F.array_join(F.transform("results", lambda r: F.concat(r["party"], F.lit("="), r["percentage"].cast("int").cast("string"))), ",")
    return H.nested_results(results(spark, d)).select("poll_id", text.alias("results"))


@query(f"WITH {BASE} SELECT poll_id, max(CASE WHEN party = '1' THEN percentage END) AS one, max(CASE WHEN party = '7' THEN percentage END) AS seven FROM result GROUP BY 1")
def h7_wide_results(spark, d):
    at = lambda p: F.try_element_at("results", F.lit(p))
    return H.wide_results(results(spark, d)).select("poll_id", at("1").alias("one"), at("7").alias("seven"))


@query(f"WITH {BASE} SELECT id, publish_date, scope, party, percentage FROM poll JOIN result ON poll_id = id WHERE party IN ('1', '2', '3')")
def h8_observations(spark, d):
    return H.observations(polls(spark, d), results(spark, d), ["1", "2", "3"]).select("id", "publish_date", "scope", "party", "percentage")


def by_poll(spark, d):
    """Polls and results laid out in eight buckets by poll and folders by year."""
    part = F.year("publish_date").alias("part")
    p = polls(spark, d).select("*", part)
    years = p.select(F.col("id").alias("poll_id"), "part")
    return laid_out(spark, p, results(spark, d).join(years, "poll_id"), 8)


@query(f"WITH {BASE} SELECT id, publish_date, scope, party, percentage FROM poll JOIN result ON poll_id = id WHERE party IN ('1', '2', '3') AND year(publish_date) >= 1997")
def h8_laid_out(spark, d):
    """Observations from tables laid out by poll: no shuffle, and only the years asked for are read."""
    p, r = by_poll(spark, d)
    rows = H.observations(p.filter("part >= 1997").drop("part"), r.filter("part >= 1997").drop("part"), ["1", "2", "3"])
    return rows.select("id", "publish_date", "scope", "party", "percentage")


@query(f"WITH {ENRICHED} SELECT 'public' AS dump, public_id, publish_date, CAST(NULL AS BOOLEAN) AS is_public FROM named UNION ALL SELECT 'audit', 'C' || lpad(CAST(id AS VARCHAR), 8, '0'), publish_date, is_public FROM served")
def h9_public_columns(spark, d):
    rows = enriched(spark, d).withColumns({"results": F.array(), "fingerprint": F.lit("x"), "public_exclusion_reason": F.lit("y")})
    public, audit = H.without_results(rows), H.without_results(rows, internal=True)
    out = None
    for name, df in (("public", public), ("audit", audit)):
        shown = F.col("is_public") if set(H.INTERNAL) <= set(df.columns) else F.lit(None).cast("boolean")
        part = df.select(F.lit(name).alias("dump"), "public_id", "publish_date", shown.alias("is_public"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {SERVED} SELECT 'default' AS dataset, id FROM gated WHERE source = 's1' UNION ALL SELECT 'all-cleaned', id FROM served WHERE source = 's1'")
def h10_datasets(spark, d):
    default, everything = (H.dataset(name, served(spark, d), checked(spark, d), GATE, source="s1").select(F.lit(name).alias("dataset"), "id") for name in H.DATASETS)
    return default.unionByName(everything)


@query(f"WITH {POLL} SELECT id, publish_date, row_number() OVER (ORDER BY publish_date DESC, id DESC) AS place FROM poll WHERE scope = 3 ORDER BY place LIMIT 25")
def h11_latest(spark, d):
    rows = H.latest(polls(spark, d), 25, 3)
    return rows.select("id", "publish_date", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("publish_date"), F.desc("id"))).cast("long").alias("place"))


@query(f"""WITH {SERVED} SELECT 'cleaned' AS kind, id, publish_date FROM served WHERE id IN (77, 78) UNION ALL SELECT 'raw', id, publish_date FROM served WHERE raw_id = 38
UNION ALL SELECT 'public', id, publish_date FROM gated WHERE id IN (73, 74, 75, 76, 77, 78, 79)""")
def h12_lookup(spark, d):
    rows, out = served(spark, d), None
    for kind, key in [("cleaned", "c00000077"), ("cleaned", "78"), ("raw", "R00000038"), *(("public", f"C{i:08d}") for i in range(73, 80))]:
        found = H.lookup(rows, key, checked(spark, d) if kind == "public" else None, GATE).select(F.lit(kind).alias("kind"), "id", "publish_date")
        out = found if out is None else out.unionByName(found)
    return out


@query("""SELECT o_orderkey AS id, 'R' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS public_id, strftime(o_orderdate, '%Y-%m-%d') AS published_date_raw, o_orderstatus AS provider_raw, CAST(o_custkey % 4 AS VARCHAR) AS scope_raw, o_orderpriority AS survey_method_raw, 'w' || CAST(o_custkey % 3 AS VARCHAR) AS worker
FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 4 = 1 AND o_custkey % 3 = 0""")
def h13_raw_audit(spark, d):
    k = F.col("o_custkey")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_date"), F.col("o_orderstatus").alias("provider"), (k % 4).cast("string").alias("scope"), F.col("o_orderpriority").alias("method_id"), F.concat(F.lit("w"), (k % 3).cast("string")).alias("worker"),
    )
    return H.raw_audit(rows, provider="O", scope="1", worker="w0")


@query(f"WITH {POLL} SELECT n_nationkey AS scope, n_name AS name, count(id) AS polls, max(publish_date) AS latest FROM (SELECT * FROM nation UNION ALL SELECT 99, 'NOWHERE', 0) LEFT JOIN poll ON scope = n_nationkey GROUP BY 1, 2")
def h14_election_summary(spark, d):
    elections = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("scope"), F.col("n_name").alias("name")).unionByName(spark.createDataFrame([(99, "NOWHERE")], "scope int, name string"))
    return H.election_summary(elections, polls(spark, d), "scope").select("scope", "name", "polls", "latest")


@query("""SELECT coalesce(CASE WHEN n_nationkey % 3 > 0 THEN 's' || CAST(n_nationkey AS VARCHAR) END, lower(key)) AS key, CASE key WHEN 'BUND' THEN 'federal' WHEN 'NW' THEN 'nrw' ELSE lower(key) END AS election_key, CASE WHEN n_nationkey % 2 = 0 THEN 'Federal election' ELSE 'State election' END AS election_type
FROM (SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'BUND' WHEN 1 THEN 'NW' ELSE n_name END AS key FROM nation)""")
def h15_scopes(spark, d):
    k = F.col("n_nationkey")
    return H.scopes_list(table(spark, d, "nation").select(F.when(k == 0, "BUND").when(k == 1, "NW").otherwise(F.col("n_name")).alias("key"), F.when(k % 3 > 0, F.concat(F.lit("s"), k.cast("string"))).alias("scope"), F.when(k % 2 == 0, "Bundestagswahl").otherwise("Landtagswahl").alias("type")))


@query("SELECT 'region' AS kind, CAST(r_regionkey AS VARCHAR) AS key, r_name AS name FROM region UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier")
def h16_reference_lists(spark, d):
    return H.reference_lists({kind: (H.reference_list(table(spark, d, kind), key), key, f"{kind[0]}_name") for kind, key in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey"))})


@query(f"WITH {SERVED} SELECT poll_id, valid FROM checked WHERE NOT valid UNION ALL SELECT -poll_id, valid FROM checked WHERE poll_id = 77")
def h17_validation_list(spark, d):
    rows = checked(spark, d)
    return H.validation_list(rows, valid=False).select("poll_id", "valid").unionByName(H.validation_list(rows, poll_id=77).select((-F.col("poll_id")).alias("poll_id"), "valid"))


@query(f"""WITH {QUALITY}, run AS (SELECT max(ts) AS last_run FROM events)
SELECT (SELECT count(*) FROM poll) AS polls, last_run, status AS validation_status, CAST(epoch(TIMESTAMP '2030-01-01 00:00:00') - floor(epoch(last_run)) AS BIGINT) AS age, CASE WHEN last_run IS NULL THEN 'warn' ELSE 'pass' END AS run_status,
CASE WHEN status = 'pass' AND last_run IS NULL THEN 'warn' ELSE status END AS status FROM quality, run""")
def h18_freshness(spark, d):
    quality = V.quality_status(validations(spark, d))
    return H.freshness(polls(spark, d), table(spark, d, "events").select(F.col("ts").alias("ended")), quality, F.lit("2030-01-01 00:00:00").cast("timestamp"))


@query(f"""WITH {POLL}, y AS (SELECT CAST(year(publish_date) AS INT) AS year, provider, source, id % 2 = 0 AS seen FROM poll)
SELECT year, CASE year WHEN 1996 THEN 'historic' ELSE 'primary' END AS primary_provider, CASE year WHEN 1997 THEN 's2' ELSE 'not configured' END AS primary_source, count(*) AS polls, count(*) FILTER (seen) AS validated,
  count(*) FILTER (provider = CASE year WHEN 1996 THEN 'historic' ELSE 'primary' END AND (year <> 1997 OR source = 's2')) AS primary_polls FROM y GROUP BY 1, 2, 3""")
def h19_year_report(spark, d):
    p = polls(spark, d)
    return H.year_report(p, p.filter("id % 2 = 0").select(F.col("id").alias("poll_id")), {1996: {"provider": "historic"}, 1997: {"source": "s2"}}, {"provider": "primary"})


#: A run is a day of events; its steps are users' events.
RUNS = """step AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, CASE user_id % 4 WHEN 0 THEN 'scraped' WHEN 1 THEN 'created' WHEN 2 THEN 'updated' ELSE 'other' END AS stage, ts, event_id % 10 AS n, event_id % 97 = 0 AS failed FROM events),
runs AS (SELECT run_id, min(ts) AS started, max(ts) AS finished, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS duration, count(*) FILTER (failed) = 0 AS success,
  coalesce(sum(n) FILTER (stage = 'scraped'), 0)::BIGINT AS scraped, coalesce(sum(n) FILTER (stage = 'created'), 0)::BIGINT AS created, coalesce(sum(n) FILTER (stage = 'updated'), 0)::BIGINT AS updated, count(*) FILTER (failed) AS errors FROM step GROUP BY 1)"""


def runs(spark, d):
    u = F.col("user_id") % 4
    steps = table(spark, d, "events").select(
        F.to_date("ts").cast("string").alias("run_id"), F.when(u == 0, "scraped").when(u == 1, "created").when(u == 2, "updated").otherwise("other").alias("stage"),
        F.col("ts").alias("started"), F.col("ts").alias("ended"), (F.col("event_id") % 10).alias("n"), (F.col("event_id") % 97 == 0).alias("failed"),
    )
    return H.run_records(steps)


@query(f"""WITH {QUALITY}, {RUNS} SELECT (SELECT count(*) FROM poll) AS polls, (SELECT count(*) FROM val) AS validated, valid, invalid, with_warning AS warning, valid_share, status, run_id, scraped, created, updated, errors
FROM quality, (SELECT * FROM runs ORDER BY finished DESC LIMIT 1)""")
def h20_report_totals(spark, d):
    return H.report_totals(polls(spark, d), V.quality_status(validations(spark, d)), H.run_of(runs(spark, d)))


@query(f"WITH {RUNS} SELECT 'history' AS part, * FROM runs UNION ALL (SELECT 'latest', * FROM runs ORDER BY finished DESC LIMIT 1) UNION ALL SELECT 'one', * FROM runs WHERE run_id = (SELECT min(run_id) FROM runs)")
def h21_run_audit(spark, d):
    new = runs(spark, d)
    history = H.append_runs(new.filter("day(started) % 2 = 0"), new)
    first = str(table(spark, d, "events").agg(F.to_date(F.min("ts"))).first()[0])
    parts = (("history", history), ("latest", H.run_of(history)), ("one", H.run_of(history, first)))
    out = None
    for part, df in parts:
        df = df.select(F.lit(part).alias("part"), "*")
        out = df if out is None else out.unionByName(df)
    return out
