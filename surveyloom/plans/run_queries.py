"""Queries of whole cleaning runs over versions of the tables (D, A16, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import run as R
from ..session import shared_folder
from ..sources.versions import Versions
from ..streaming.ingest import ingest_and_clean
from .cleaning_queries import _PAYLOAD
from .derived import RAW_SQL, raw, table
from .registry import query
from .text_queries import COUNT, METHOD, PUBLISH, RANGE_AT, STATE, _CODE, _INSTITUTE, _METHOD, _PARTY, frame_sql, kinds

#: Every third row comes again, under a number of its own: a copy by another provider where it is even.
SHIFT = 1_000_000_000


def raw_polls(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows (R.RAW) made from orders."""
    rows = raw(spark, d).select(
        "id", F.col("publish_raw").alias("publish_date"), F.lit(None).cast("string").alias("survey_date_start"), F.lit("").alias("survey_date_end"), F.col("respondents_raw").alias("respondents"), F.col("frame").alias("zeitraum"),
        F.expr(_PAYLOAD).alias("parties"), F.col("institute_raw").alias("institute_id"), F.when(F.col("id") % 4 == 0, "primary").otherwise(" ").alias("provider"), F.lit("html").alias("source"), F.col("scope_raw").alias("scope"),
        F.col("election_raw").alias("election_id"), F.col("method_raw").alias("method_id"), F.col("publish_raw").alias("date_downloaded"),
    )
    again = rows.filter("id % 3 = 0").withColumns({"id": F.col("id") + SHIFT, "provider": F.when(F.col("id") % 2 == 0, "secondary").otherwise(F.col("provider"))})
    return rows.unionByName(again)


_RESULTS = f"""CASE id % 4 WHEN 0 THEN CASE WHEN id % 8 = 0 AND {_PARTY} IS NOT NULL THEN concat({_PARTY}, '=', CAST(id % 40 + 0.5 AS VARCHAR)) END
  WHEN 3 THEN CASE WHEN {_PARTY} = 'SPD' THEN 'SPD=5.0' WHEN {_PARTY} IS NULL THEN 'SPD=20.0' WHEN {_PARTY} < 'SPD' THEN concat({_PARTY}, '=5.0,SPD=20.0') ELSE concat('SPD=20.0,', {_PARTY}, '=5.0') END END"""
#: What cleaning makes of a row, as literal results of its kinds, and what of it is left after batches.
_CLEAN = f"""{RAW_SQL.replace('raw AS', 'raw0 AS')}, raw AS (SELECT *, {PUBLISH} AS pub FROM raw0), {frame_sql('frame', 'year(pub)')},
late AS (SELECT *, pub IS NOT NULL AND NOT regexp_matches(coalesce(frame, ''), '\\b\\d{{4}}\\b') AS yearless FROM frames),
moved AS (SELECT *, CASE WHEN yearless AND f_end > pub THEN CAST(f_start - INTERVAL 1 YEAR AS DATE) ELSE f_start END AS s, CASE WHEN yearless AND f_end > pub THEN CAST(f_end - INTERVAL 1 YEAR AS DATE) ELSE f_end END AS e FROM late),
said AS (SELECT id, pub AS publish_date, coalesce(CASE WHEN yearless AND s > e THEN CAST(s - INTERVAL 1 YEAR AS DATE) ELSE s END, {RANGE_AT(1)}) AS survey_start, coalesce(e, {RANGE_AT(2)}) AS survey_end,
  CASE WHEN id % 24 = 22 THEN 1234 ELSE {COUNT} END AS respondents, {kinds(9, _INSTITUTE)} AS institute, CASE WHEN id % 4 = 0 THEN 'primary' ELSE 'Unknown' END AS provider, coalesce({METHOD}, {kinds(8, _METHOD)}) AS method,
  CASE WHEN id % 3 = 0 THEN 'EU_WAHLEN' ELSE {STATE} END AS election, {_CODE} AS scope, {_RESULTS} AS results, pub IS NOT NULL AND NOT f_ignore AS kept FROM moved),
twice AS (SELECT * FROM said UNION ALL SELECT * REPLACE (id + {SHIFT} AS id, CASE WHEN id % 2 = 0 THEN 'secondary' ELSE provider END AS provider) FROM said WHERE id % 3 = 0),
good AS (SELECT *, {{batch}} AS batch FROM twice WHERE kept AND results IS NOT NULL),
firsts AS (SELECT *, first_value(id) OVER w AS holder FROM good WINDOW w AS (PARTITION BY publish_date, survey_start, survey_end, respondents, institute, provider, method, election, scope, results ORDER BY batch, id)),
made AS (SELECT *, row_number() OVER (ORDER BY batch, id) AS poll_id FROM firsts WHERE holder = id)"""
#: Odd rows are cleaned before even ones.
_BY_PARITY = _CLEAN.replace("{batch}", "CASE id % 2 WHEN 1 THEN 1 ELSE 2 END")
_SHOWN = "CAST(poll_id AS BIGINT) AS id, publish_date, survey_start, survey_end, CAST(respondents AS INT) AS respondents, institute, provider, method, election, scope, results"


def shown(tables: Versions, version: int | None = None) -> DataFrame:
    """Polls with their results, and duplicates with the poll that they repeat, by raw id."""
    polls, results, duplicates = (tables.read(name, schema, version) for name, schema in (("polls", R.POLLS), ("results", R.RESULTS), ("duplicates", R.DUPLICATES)))
    texts = results.groupBy("poll_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "party", "percentage"))), ",").alias("results"))
    fields = ("publish_date", "survey_start", "survey_end", "respondents", "institute", "provider", "method", "election", "scope")
    kept = polls.join(texts, F.col("id") == F.col("poll_id")).select("raw_id", F.lit("poll").alias("kind"), "id", *fields, "results")
    none = [F.lit(None).cast(dict(polls.dtypes)[c]).alias(c) for c in fields]
    return kept.unionByName(duplicates.select(F.col("id").alias("raw_id"), F.lit("duplicate").alias("kind"), F.col("duplicate_of").alias("id"), *none, F.lit(None).cast("string").alias("results")))


_ALL = f"""WITH {_BY_PARITY} SELECT id AS raw_id, 'poll' AS kind, {_SHOWN} FROM made
UNION ALL SELECT f.id, 'duplicate', CAST(m.poll_id AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM firsts f JOIN made m ON m.id = f.holder WHERE f.id <> f.holder"""


@query(_ALL)
def d6_cleaning_runs(spark, d):
    """Odd rows in one run, then all in one that reprocesses: polls that exist stay in place."""
    tables, rows = Versions(spark, shared_folder(spark, "runs")), raw_polls(spark, d)
    for part, mode in ((rows.filter("id % 2 = 1"), "incremental"), (rows, "reprocess")):
        R.commit_run(tables, R.clean_run(spark, tables, part, mode))
    return shown(tables)


@query(f"""WITH {_BY_PARITY}, v AS (SELECT 1 AS version UNION ALL SELECT 2) SELECT CAST(version AS BIGINT) AS version, CAST(year(publish_date) AS INT) AS year, count(*) AS polls FROM made, v WHERE batch <= version GROUP BY ALL""")
def d7_versions(spark, d):
    """Polls by year as of each of two versions."""
    tables, rows = Versions(spark, shared_folder(spark, "versions")), raw_polls(spark, d)
    out = None
    for part in (rows.filter("id % 2 = 1"), rows):
        version, _ = R.commit_run(tables, R.clean_run(spark, tables, part))
        polls = tables.read("polls", R.POLLS, version)
        counts = polls.groupBy(F.col("part").alias("year")).agg(F.count("*").alias("polls")).select(F.lit(version).cast("long").alias("version"), "year", "polls")
        out = counts if out is None else out.unionByName(counts)
    return out


@query(f"""WITH {_BY_PARITY}, outcomes AS (SELECT twice.id, made.id IS NOT NULL AS made FROM twice LEFT JOIN made USING (id) WHERE twice.id % 2 = 1)
SELECT count(*) AS processed, count(*) FILTER (made) AS created, CAST(0 AS BIGINT) AS updated, count(*) FILTER (NOT made) AS skipped FROM outcomes""")
def d10_observed_counters(spark, d):
    """The counters that the writing passes of a run saw."""
    run = R.clean_run(spark, Versions(spark, shared_folder(spark, "counted")), raw_polls(spark, d).filter("id % 2 = 1"))
    c = R.dry_run(run)
    names = ("processed", "created", "updated", "skipped")
    return run.outcomes.limit(1).select(*[F.lit(c[n]).cast("long").alias(n) for n in names])


@query(f"""WITH {_CLEAN.replace('{batch}', '1')},
entered AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders)
SELECT entered.id AS raw_id, publish_date, institute, scope, results FROM good JOIN entered ON entered.k = good.id""")
def a16_ingest_and_clean(spark, d):
    """Raw rows land in two runs in the order of their numbers, some of the first again in the second; each landing is cleaned in its batch."""
    folder = shared_folder(spark, "landing")
    tables, rows = Versions(spark, f"{folder}/tables"), raw_polls(spark, d).filter(f"id < {SHIFT}").withColumn("seq", F.col("id"))
    # Sources tell rows apart: without a name of its own a row would repeat another.
    rows = rows.withColumn("source", F.concat(F.lit("html"), F.col("seq").cast("string"))).drop("id")
    top = table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]
    for landed in (F.col("seq") <= top // 2, (F.col("seq") > top // 2) | (F.col("seq") <= top // 9)):
        rows.filter(landed).write.mode("append").json(f"{folder}/in")
        ingest_and_clean(spark, f"{folder}/in", tables, f"{folder}/checkpoint")
    polls, results = tables.read("polls", R.POLLS), tables.read("results", R.RESULTS)
    texts = results.groupBy("poll_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "party", "percentage"))), ",").alias("results"))
    return polls.join(texts, F.col("id") == F.col("poll_id")).select("raw_id", "publish_date", "institute", "scope", "results")
