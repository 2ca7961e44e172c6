"""Queries of imports and exports (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import views as H
from ..session import shared_folder
from ..sources import imports as I, span_tables as T
from ..streaming.ingest import ingest_new
from .derived import POLL, RESULT, polls, results, table
from .registry import query


@query("""WITH r AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber < 7 THEN 'P' ELSE '' END || CAST(l_linenumber AS VARCHAR) AS party, max(l_quantity) AS percentage FROM lineitem GROUP BY 1, l_linenumber)
SELECT k AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS publish_date, CASE k % 3 WHEN 0 THEN 'BT' WHEN 1 THEN 'BY' END AS parliament, CASE WHEN k % 7 < 5 THEN 'i' || CAST(k % 7 AS VARCHAR) END AS institute, 't' || CAST(k % 2 AS VARCHAR) AS tasker, 'm ' || o_orderpriority AS method,
  CASE WHEN k % 4 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS survey_date_start, CASE WHEN k % 4 > 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS survey_date_end, party, percentage FROM orders JOIN r ON k = o_orderkey""")
def a5_json_dump(spark, d):
    """Dumps of at most 64 surveys each, with their own tables of names."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate").cast("string")
    entries = F.collect_list(F.struct("party", F.col("percentage").cast("string")))
    r = results(spark, d).groupBy("poll_id").agg(F.map_concat(F.map_from_entries(F.array_sort(entries)), F.create_map(F.lit("9"), F.lit("k.A."))).alias("Results"))
    period = F.when(k % 4 > 0, F.struct(day.alias("Date_Start"), F.when(k % 4 > 1, day).alias("Date_End")))
    survey = F.struct(day.alias("Date"), (k % 3).cast("string").alias("Parliament_ID"), (k % 7).cast("string").alias("Institute_ID"), (k % 2).cast("string").alias("Tasker_ID"), F.col("o_orderpriority").alias("Method_ID"), period.alias("Survey_Period"), "Results")
    surveys = table(spark, d, "orders").join(r, k == F.col("poll_id")).select("o_orderkey", survey.alias("s"))
    names = lambda field, **rows: F.create_map(*[x for key, v in rows.items() for x in (F.lit(key.strip("_")), F.struct(F.lit(v).alias(field)))])
    methods = table(spark, d, "orders").select(F.col("o_orderpriority").alias("key"), F.struct(F.concat(F.lit("m "), "o_orderpriority").alias("Name")).alias("v")).distinct().agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("Methods"))
    dumps = surveys.groupBy(F.floor(k / 64).alias("part")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), "s"))).alias("Surveys")).crossJoin(F.broadcast(methods)).select(
        F.to_json(F.struct(
            names("Shortcut", _0="BT", _1="BY").alias("Parliaments"), names("Name", **{f"_{i}": f"i{i}" for i in range(5)}).alias("Institutes"), names("Name", _0="t0", _1="t1").alias("Taskers"), "Methods",
            names("Shortcut", **{f"_{i}": f"P{i}" for i in range(1, 7)}).alias("Parties"), "Surveys",
        )).alias("dump")
    )
    flat = I.flatten_dump(dumps, "dump")
    return flat.select(
        F.col("survey_id").cast("long").alias("id"), F.col("Date").alias("publish_date"), F.col("Parliament").alias("parliament"), F.col("Institute").alias("institute"), F.col("Tasker").alias("tasker"), F.col("Method").alias("method"),
        "survey_date_start", "survey_date_end", F.explode("parties").alias("party", "percentage"),
    )


@query("SELECT o_orderkey AS survey_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS publish_date, 'dump' AS provider, 'api' AS source, 'federal' AS scope FROM orders")
def a6_rename_and_tag(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("Date"))
    return I.rename_and_tag(rows, {"o_orderkey": "survey_id", "Date": "publish_date"}, {"provider": "dump", "source": "api", "scope": "federal"})


@query("""SELECT o_orderkey AS id, nullif(trim(o_orderpriority), '') AS institute_id, CASE WHEN o_orderkey % 2 = 0 THEN 'own' ELSE 'csv_import' END AS source, '99' AS method_id, 'import:csv' AS worker, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS publish_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'FDP=7' WHEN 1 THEN NULL WHEN 2 THEN 'CDU=' || CAST(o_orderkey % 40 AS VARCHAR) || ',SPD=' || CAST(o_orderkey % 30 AS VARCHAR) END AS parties,
  CASE o_orderkey % 4 WHEN 1 THEN 'the party results are no JSON object' WHEN 3 THEN 'there is no column with party results' END AS parties_error FROM orders""")
def a7_header_aliases(spark, d):
    """CSV files written from orders and read back, of two orders of columns, with aliases, defaults and rows without parties."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        k.alias("id"), F.lit("  ").alias(" Institute_ID "), F.col("o_orderpriority").alias("Institut"), F.when(k % 2 == 0, "own").alias("Source"), F.to_date("o_orderdate").cast("string").alias("DATUM"),
        F.when(k % 4 == 0, '{"FDP": 7}').when(k % 4 == 1, "[1]").alias("Results"), F.when(k % 4 == 2, (k % 40).cast("string")).alias("CDU"), F.when(k % 4 == 2, (k % 30).cast("string")).alias(" SPD"),
    )
    folder = shared_folder(spark, "csv")
    for part, columns in (("id % 3 = 0", rows.columns), ("id % 3 > 0", rows.columns[::-1])):
        rows.filter(part).select(*columns).write.csv(folder, mode="append", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    out = I.csv_import(I.read_csv(spark, folder), keep=["id"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries("parties")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select(F.col("id").cast("long").alias("id"), "institute_id", "source", "method_id", "worker", "publish_date", text.alias("parties"), "parties_error")


@query("""SELECT o_orderkey AS id, 'CDU' AS party, CAST(o_orderkey % 40 AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS error FROM orders WHERE o_orderkey % 4 > 0 UNION ALL SELECT o_orderkey, 'SPD', CAST(o_orderkey % 30 AS VARCHAR), NULL FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 > 0
UNION ALL SELECT o_orderkey, NULL, NULL, 'there is no column with party results' FROM orders WHERE o_orderkey % 4 = 0""")
def a8_unpivot_parties(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.alias("id"), F.when(k % 4 > 0, (k % 40).cast("string")).alias("CDU"), F.when((k % 3 != 0) & (k % 4 > 0), (k % 30).cast("string")).otherwise("").alias("SPD"))
    return I.unpivot_parties(rows, {"id"}).select("id", F.explode_outer("parties").alias("party", "value"), F.col("parties_error").alias("error"))


_LONG = """lines AS (SELECT CASE l_suppkey % 10 WHEN 0 THEN 'AUT' ELSE 'DEU' END AS country, l_shipdate, l_suppkey, l_linenumber, l_quantity FROM lineitem)"""


@query(f"""WITH {_LONG}, g AS (SELECT CAST(l_shipdate AS DATE) AS publish_date, l_suppkey, l_linenumber AS n, count(DISTINCT l_quantity) AS values_, max(l_quantity) AS v FROM lines WHERE country = 'DEU' AND l_linenumber < 7 AND l_suppkey % 11 > 0 GROUP BY 1, 2, 3)
SELECT publish_date, CASE l_suppkey % 4 WHEN 0 THEN 'Verian (Emnid)' WHEN 1 THEN 'Institut Wahlkreisprognose' WHEN 2 THEN 'Unknown' ELSE 'Own' END AS institute_id, l_suppkey % 4 AS kind,
string_agg(CASE n WHEN 1 THEN 'AfD' WHEN 2 THEN 'CDU/CSU' WHEN 3 THEN 'Grüne' WHEN 4 THEN 'Linke' WHEN 5 THEN 'SPD' ELSE 'Sonstige' END || '=' || CAST(CAST(v AS INT) AS VARCHAR), ',' ORDER BY n) AS results FROM g GROUP BY publish_date, l_suppkey HAVING max(values_) = 1""")
def a9_grouped_import(spark, d):
    """Lines as a long file: a tenth of the suppliers is abroad, some dates can't be read, a seventh party has no name here; groups by supplier stay apart by name or day."""
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    name = F.when(s % 4 == 0, "Emnid Archived x").when(s % 4 == 1, "Wahlkreisprognose (MRP)").when(s % 4 == 2, "").otherwise("Own (intermediate result)")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    rows = table(spark, d, "lineitem").select(
        F.when(s % 10 == 0, "AUT").otherwise("DEU").alias("country_iso3c"), F.when(s % 11 == 0, "some day").when(s % 2 == 0, F.concat(day, F.lit(" 00:00:00"))).otherwise(F.date_format("l_shipdate", "d.M.yyyy")).alias("survey_date"), name.alias("institute"), s.alias("supplier"),
        F.element_at(F.array(*[F.lit(p) for p in ("AfD", "CDU/CSU", "Greens", "PDS/Linke", "SPD", "Other", "X")]), n).alias("party_name_short"), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",0")).alias("poll"),
    )
    # The importer groups by day and institute; suppliers are told apart by a mark in the name, taken off again.
    marked = rows.withColumn("institute", F.concat(F.lpad(F.col("supplier").cast("string"), 9, "0"), F.lit("|"), "institute"))
    out = I.long_import(marked)
    own, kind = F.substring_index("institute_id", "|", -1), F.substring_index("institute_id", "|", 1).cast("long") % 4
    order = F.array(*[F.lit(p) for p in ("AfD", "CDU/CSU", "Grüne", "Linke", "SPD", "Sonstige")])
    text = F.array_join(F.transform(F.array_sort(F.transform(F.map_entries("parties"), lambda e: F.struct(F.array_position(order, e["key"]).alias("n"), e["key"].alias("key"), e["value"].alias("value")))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select("publish_date", I.institute_text(own).alias("institute_id"), kind.alias("kind"), text.alias("results"))


@query("""SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, CASE l_partkey % 4 WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.5' WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.123457' END AS number,
  CASE l_suppkey % 5 WHEN 0 THEN 'Verian (Emnid)' WHEN 1 THEN 'Infratest Dimap' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'Inst 3' ELSE 'pollytix' END AS institute, CASE l_partkey % 3 WHEN 2 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS day FROM lineitem""")
def a10_long_values(spark, d):
    n, p, s = F.col("l_quantity").cast("int").cast("string"), F.col("l_partkey"), F.col("l_suppkey")
    number = F.when(p % 4 == 0, F.concat(n, F.lit(",0"))).when(p % 4 == 1, F.concat(F.lit(" "), n, F.lit(".50"))).when(p % 4 == 2, F.concat(n, F.lit(",1234567"))).otherwise("k.A.")
    name = F.when(s % 5 == 0, "Emnid Archived 2001 (MRP)").when(s % 5 == 1, "Infratest dimap (intermediate result)").when(s % 5 == 2, " ").when(s % 5 == 3, "Inst 3 (MRP)").otherwise("Pollytix")
    day = F.when(p % 3 == 0, F.date_format("l_shipdate", "yyyy-MM-dd 00:00:00")).when(p % 3 == 1, F.date_format("l_shipdate", "d.M.yyyy")).otherwise("some day")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), p.alias("p"), I.number_text(number).alias("number"), I.institute_text(name).alias("institute"), I.long_date(day).alias("day"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'n' || CAST(o_orderkey AS VARCHAR) END AS respondents FROM orders WHERE o_orderkey % 9 <> 0")
def a11_payload_filter(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, F.repeat(F.lit("x"), 41)).otherwise(F.concat(F.lit("n"), F.col("o_orderkey").cast("string"))).alias("respondents"), F.when(F.col("o_orderkey") % 9 == 0, F.lit("[1]")).otherwise('{"SPD": 3}').alias("parties"))
    good, _ = I.payload_filter(rows)
    return good.select("id", "respondents")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 1 THEN '1 234' END AS respondents, CASE WHEN o_orderkey % 3 = 2 THEN '01.–05.03.2024' END AS zeitraum, CASE WHEN o_orderkey % 2 = 0 THEN 'dump' ELSE 'html_scraper' END AS source, '99' AS method_id,
  '{"CDU":"' || CAST(o_orderkey % 40 AS VARCHAR) || '","SPD":"20"}' AS parties FROM orders""")
def a12_raw_rows(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        k.alias("id"), F.lit(" ").alias("respondents"), F.when(k % 3 == 0, "Bundestagswahl").when(k % 3 == 1, "1 234").otherwise("01.–05.03.2024").alias("zeitraum"), F.when(k % 2 == 0, "dump").otherwise(" ").alias("source"),
        F.create_map(F.lit("SPD"), F.lit("20"), F.lit("CDU"), (k % 40).cast("string")).alias("parties"),
    )
    return I.raw_rows(rows)


_NESTED = f"{RESULT}, nested AS (SELECT poll_id, CAST(to_json(list({{'party': party, 'percentage': percentage}} ORDER BY party)) AS VARCHAR) AS results FROM result GROUP BY 1)"


@query(f"WITH {_NESTED} SELECT format, poll_id, results FROM nested, (VALUES ('json'), ('csv'), ('parquet')) AS f(format)")
def a13_export(spark, d):
    """Nested results written in the three formats and read back."""
    folder = shared_folder(spark, "export")
    nested = H.nested_results(results(spark, d))
    I.export(nested, folder)
    text = I.flat_cells(spark.read.schema(nested.schema).json(f"{folder}/json")).select(F.lit("json").alias("format"), "poll_id", "results")
    flat = "poll_id long, results string"
    csv = spark.read.schema(flat).csv(f"{folder}/csv", header=True, escape='"').select(F.lit("csv").alias("format"), "poll_id", "results")
    return text.unionByName(csv).unionByName(spark.read.schema(flat).parquet(f"{folder}/parquet").select(F.lit("parquet").alias("format"), "poll_id", "results"))


@query(f"WITH {_NESTED} SELECT poll_id, results FROM nested")
def a14_flat_cells(spark, d):
    return I.flat_cells(H.nested_results(results(spark, d)))


@query(f"WITH {POLL}, {RESULT} SELECT (SELECT count(*) FROM poll WHERE provider = 'primary') AS public_polls, (SELECT count(*) FROM poll) AS polls, (SELECT count(*) FROM result) AS results, (SELECT count(*) FROM orders) AS raw, 'public_polls.json,public_polls.csv,public_polls.parquet,polls.json,polls.csv,polls.parquet,results.json,results.csv,results.parquet,raw.json,raw.csv,raw.parquet' AS files")
def a15_manifest(spark, d):
    p, r = polls(spark, d), results(spark, d)
    return I.manifest({"public_polls": p.filter("provider = 'primary'"), "polls": p, "results": r, "raw": table(spark, d, "orders")})


@query("SELECT event_type, user_id, CAST(ts AS DATE) AS day, min(event_id) AS event_id FROM events GROUP BY 1, 2, 3")
def a16_incremental_ingest(spark, d):
    """Events of odd ids land first, then all of them: of each type, user and day the first one stays, whichever landed first."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    first = events.groupBy("event_type", "user_id", "day").agg(F.min("event_id").alias("event_id")).select(*events.columns)
    folder = shared_folder(spark, "ingest")
    for landed in (first.filter("event_id % 2 = 1"), events):
        landed.write.mode("append").json(f"{folder}/landing")
        ingest_new(spark, f"{folder}/landing", events.schema, f"{folder}/target", f"{folder}/checkpoint", ["event_type", "user_id", "day"], "event_id", partition_by="day")
    return spark.read.schema(events.schema).parquet(f"{folder}/target").select("event_type", "user_id", "day", "event_id")


@query("SELECT n_nationkey AS key, CASE WHEN n_nationkey < 10 THEN 'same' WHEN n_nationkey < 20 THEN 'changed' ELSE 'new' END AS action, n_name AS name FROM nation UNION ALL SELECT -1, 'kept', 'OLD'")
def a17_dimension_upsert(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name"), F.create_map(F.lit("id"), F.col("n_regionkey").cast("string")).alias("external_ids"))
    old = n.filter("key < 20").withColumn("external_ids", F.when(F.col("key") >= 10, F.create_map(F.lit("id"), F.lit("x"))).otherwise(F.col("external_ids")))
    old = old.unionByName(n.limit(1).select(F.lit(-1).cast("long").alias("key"), F.lit("OLD").alias("name"), "external_ids"))
    merged, _ = I.upsert_dimension(old, n, "key")
    return merged.join(I.dimension_changes(old, n, "key").select("key", "action"), "key", "left").select("key", F.coalesce("action", F.lit("kept")).alias("action"), "name")


@query("""SELECT o_orderkey AS id, strftime(o_orderdate, '%d.%m.%Y') AS day, o_orderpriority AS institute, 'SPD' AS party, CAST(o_orderkey % 40 AS VARCHAR) AS value FROM orders WHERE o_orderkey % 9 > 0
UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y'), o_orderpriority, 'CDU', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 9 > 0""")
def a1_html_tables(spark, d):
    """Tables assembled from orders, with and without thead, and the given pages, which hold none."""
    k = F.col("o_orderkey")
    row = F.concat(F.lit("<tr>"), _td(F.date_format("o_orderdate", "dd.MM.yyyy")), _td(F.col("o_orderpriority")), _td(k), F.when(k % 9 > 0, F.concat(_td(k % 40), _td(F.when(k % 3 > 0, F.concat(F.lit("&nbsp;"), F.col("o_custkey").cast("string"))).otherwise(" ")))).otherwise(""), F.lit("</tr>"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("tr")))), lambda x: x["tr"]), "")
    heads = "".join(f"<th>{h}</th>" for h in ("", "Institut", "Befragte", "SPD", "CDU"))
    page = F.floor(k / 64)
    html = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(f"<table class='wilko'><thead><tr>{heads}</tr></thead><tbody>"), "rows", F.lit("</tbody></table>"))).otherwise(F.concat(F.lit(f"<table class='x wilko'><tr>{heads}</tr>"), "rows", F.lit("</table>")))
    pages = table(spark, d, "orders").groupBy(page.alias("page_id")).agg(parts.alias("rows")).select("page_id", html.alias("html"))
    out = T.plain_tables(pages.unionByName(table(spark, d, "pages").select((-1 - F.col("page_id")).alias("page_id"), "html")))
    return out.select(F.col("fields")["Befragte"].cast("long").alias("id"), F.col("fields")["Datum"].alias("day"), F.col("fields")["Institut"].alias("institute"), F.explode("parties").alias("party", "value"))


def _pages(rows, heads, row):
    """Pages of at most 64 orders, as HTML: two tables of another kind first where the third is asked for."""
    head = "<thead><tr>" + "".join(f"<th>{h}</th>" for h in heads) + "</tr></thead><tbody>"
    parts = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("tr")))), lambda x: x["tr"])
    return rows.groupBy(F.floor(F.col("o_orderkey") / 64).alias("page_id")).agg(F.concat(F.lit(head), F.array_join(parts, ""), F.lit("</tbody></table>")).alias("html"))


def _td(c, attrs=""):
    return F.concat(F.lit(f"<td{attrs}>"), c.cast("string"), F.lit("</td>"))


@query("""WITH o AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%d.%m.%Y') AS day, o_orderpriority AS institute, CAST(o_custkey AS VARCHAR) AS respondents FROM orders)
SELECT id, day, institute, respondents, 'CDU/CSU' AS party, CAST(id % 40 AS VARCHAR) AS value FROM o WHERE id % 3 = 0
UNION ALL SELECT id, day, institute, respondents, 'CDU', CAST(id % 31 AS VARCHAR) FROM o WHERE id % 3 <> 0
UNION ALL SELECT id, day, institute, respondents, 'CSU', CAST(id % 7 AS VARCHAR) FROM o WHERE id % 3 = 1
UNION ALL SELECT id, day, institute, respondents, 'SPD', CAST(id % 29 AS VARCHAR) FROM o""")
def a2_column_spans(spark, d):
    k = F.col("o_orderkey")
    union = F.when(k % 3 == 0, _td(k % 40, " colspan='2'")).otherwise(F.concat(_td(k % 31), _td(F.when(k % 3 == 1, (k % 7).cast("string")).otherwise(""))))
    row = F.concat(F.lit("<tr>"), _td(F.date_format("o_orderdate", "dd.MM.yyyy")), F.lit("<td></td>"), _td(F.col("o_orderpriority")), _td(k), _td(F.col("o_custkey")), F.lit("<td>-</td>"), union, _td(k % 29), F.lit("<td>99</td></tr><tr><td>Wahl 2019</td></tr>"))
    pages = _pages(table(spark, d, "orders"), ["Datum", "", "Institut", "Auftraggeber", "Befragte", "", "CDU", "CSU", "SPD"], row).withColumn("html", F.concat(F.lit("<table class='wilko'>"), "html"))
    out = T.spanned_tables(pages).withColumn("r", F.explode("results"))
    return out.select(F.col("client").cast("long").alias("id"), F.col("date").alias("day"), "institute", "respondents", "r.party", "r.value")


@query("""SELECT o_orderkey AS id, o_orderpriority AS institute, strftime(o_orderdate, '%d.%m.%y') AS day, CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN ' Telefon' ELSE '' END AS respondents,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '01.05.-03.05.' END AS timeframe, CAST(o_orderkey % 29 AS VARCHAR) AS spd,
  coalesce(last_value(CASE o_orderkey % 10 WHEN 0 THEN 'BB' WHEN 4 THEN 'SN' WHEN 7 THEN 'TH' END IGNORE NULLS) OVER (PARTITION BY o_orderkey // 64 ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'BUND') AS state FROM orders""")
def a3_row_groups(spark, d):
    k = F.col("o_orderkey")
    state = F.when(k % 10 == 0, "bb").when(k % 10 == 4, "sn").when(k % 10 == 7, "th")
    lead = F.coalesce(F.concat(F.lit("<th class='li' id='"), state, F.lit("'>Land</th><td></td>")), F.lit(""))
    asked = F.concat(F.when(k % 2 == 0, "<td title='Telefon'>").otherwise("<td>"), F.col("o_custkey").cast("string"), F.when(k % 5 == 0, "").otherwise("<br>01.05.-03.05."), F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), lead, _td(F.concat("o_orderpriority", F.lit(" ("), F.date_format("o_orderdate", "dd.MM.yy"), F.lit(")"))), _td(k), asked, F.lit("<td>-</td>"), _td(k % 29), F.lit("</tr>"))
    before = "<table class='wilko'></table><table class='wilko'></table><table class='wilko'>"
    pages = _pages(table(spark, d, "orders"), ["Land", "", "Institut", "Auftraggeber", "Befragte", "", "SPD"], row).withColumn("html", F.concat(F.lit(before), "html"))
    out = T.grouped_tables(pages)
    return out.select(F.col("client").cast("long").alias("id"), "institute", F.col("date").alias("day"), "respondents", "timeframe", F.get("results", F.lit(0))["value"].alias("spd"), "state")


@query("""SELECT o_orderkey AS id, CAST(c_nationkey AS INT) AS state, c_mktsegment AS scope, 'p' || CAST(c_nationkey % 3 AS VARCHAR) AS provider, c_mktsegment AS survey_type,
  CASE WHEN c_nationkey % 2 = 0 THEN coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END, c_name) WHEN c_custkey IS NOT NULL THEN c_name END AS institute
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 5 <> 0""")
def a4_source_catalogue(spark, d):
    nation = F.col("c_nationkey")
    catalogue = table(spark, d, "customer").filter("c_custkey % 5 <> 0").select(
        F.col("c_custkey").alias("worker"), nation.cast("int").alias("state"), F.col("c_mktsegment").alias("scope"), F.col("c_name").alias("institute"),
        F.concat(F.lit("p"), (nation % 3).cast("string")).alias("provider"), F.col("c_mktsegment").alias("survey_type"), (nation % 2 == 0).alias("own_institute"),
    )
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("worker"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("institute"))
    return I.enrich_by_worker(rows, catalogue).drop("worker")
