"""Poll tables derived from the given order tables, for Spark and, as common table expressions, for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ELECTION = "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('E', CAST(c_nationkey % 2 AS STRING)) END"
PROVIDER = "CASE o_orderstatus WHEN 'O' THEN 'primary' WHEN 'P' THEN 'secondary' ELSE 'historic' END"

POLL = f"""poll AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS publish_date, {PROVIDER} AS provider, CAST(c_custkey % 6 AS INT) AS institute, CAST(c_nationkey AS INT) AS scope,
  o_orderpriority AS method, {ELECTION} AS election, concat('s', CAST(o_custkey % 3 AS STRING)) AS source, CAST(floor(o_totalprice / 100) AS INT) AS respondents,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9 AS INT) AS DATE) END AS survey_start,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 4 AS INT) AS DATE) END AS survey_end
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
RESULT = "result AS (SELECT l_orderkey AS poll_id, CAST(l_linenumber AS VARCHAR) AS party, max(l_quantity) AS percentage FROM lineitem GROUP BY 1, 2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day = F.to_date("o_orderdate")
    known = F.col("o_orderkey") % 11 != 0
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), day.alias("publish_date"), F.expr(PROVIDER).alias("provider"), (F.col("c_custkey") % 6).cast("int").alias("institute"), F.col("c_nationkey").cast("int").alias("scope"),
        F.col("o_orderpriority").alias("method"), F.expr(ELECTION).alias("election"), F.expr("concat('s', CAST(o_custkey % 3 AS STRING))").alias("source"), F.floor(F.col("o_totalprice") / 100).cast("int").alias("respondents"),
        F.when(known, F.date_sub(day, (F.col("o_orderkey") % 9).cast("int"))).alias("survey_start"), F.when(known, F.date_sub(day, (F.col("o_orderkey") % 4).cast("int"))).alias("survey_end"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (poll, party) rows are resolved to the greatest value."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("poll_id"), F.col("l_linenumber").cast("string").alias("party")).agg(F.max("l_quantity").alias("percentage"))


SHIFT = 1_000_000_000
MATCH_TABLES = f"""{POLL}, {RESULT},
mpoll AS (SELECT * FROM poll WHERE provider <> 'historic' UNION ALL SELECT id + {SHIFT}, CAST(publish_date + 2 AS DATE), 'secondary', institute, scope, method, CASE WHEN id % 4 = 0 THEN 'E9' ELSE election END, source, respondents, survey_start, survey_end FROM poll WHERE provider = 'primary' AND id % 3 = 0),
mresult AS (SELECT * FROM result UNION ALL SELECT poll_id + {SHIFT}, party, percentage + 0.5 FROM result WHERE poll_id % 3 = 0)"""


def match_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Polls and results in which every third primary poll has a shifted copy at the secondary provider."""
    p, r = polls(spark, sf_dir), results(spark, sf_dir)
    copy = p.filter("provider = 'primary' and id % 3 = 0").withColumns({"id": F.col("id") + SHIFT, "publish_date": F.date_add("publish_date", 2), "provider": F.lit("secondary"), "election": F.when(F.col("id") % 4 == 0, "E9").otherwise(F.col("election"))})
    return p.filter("provider <> 'historic'").unionByName(copy), r.unionByName(r.filter("poll_id % 3 = 0").withColumns({"poll_id": F.col("poll_id") + SHIFT, "percentage": F.col("percentage") + 0.5}))


#: Raw text columns made from orders: expressions that both engines read alike.
_D, _M, _Y = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')", "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')", "CAST(year(o_orderdate) AS STRING)"
_E = "lpad(CAST(day(o_orderdate) % 28 + 1 AS STRING), 2, '0')"
_K = "o_orderkey"
RAW = {
    "id": _K,
    "publish_raw": f"CASE {_K} % 7 WHEN 0 THEN concat({_Y}, '-', {_M}, '-', {_D}) WHEN 1 THEN concat({_Y}, '-', {_M}, '-', {_D}, 'T10:00:00') WHEN 2 THEN concat({_Y}, '-', {_M}, '-', {_D}, 'T10:00:00Z') WHEN 3 THEN concat({_D}, '.', {_M}, '.', {_Y}) WHEN 4 THEN concat({_D}, '. Januar ', {_Y}) WHEN 5 THEN 'not-a-date' ELSE '' END",
    "frame": f"CASE {_K} % 12 WHEN 0 THEN concat({_D}, '.', {_M}, '.-', {_E}, '.', {_M}, '.', {_Y}) WHEN 1 THEN concat('01.–', {_E}, '.', {_M}, '.', {_Y}) WHEN 2 THEN concat('01.', {_M}, '.', {_Y}, ' - ', {_E}, '.', {_M}, '.', {_Y}) WHEN 3 THEN '20:15-22:00 Uhr' WHEN 4 THEN '??.09.–??.09.' WHEN 5 THEN 'Bundestagswahl' WHEN 6 THEN concat({_E}, '.', {_M}, '.–28.', {_M}, '.') WHEN 7 THEN concat('bis ', {_E}, '.', {_M}, '.') WHEN 8 THEN concat({_E}, '.', {_M}, '.') WHEN 9 THEN '31.02.–31.02.' WHEN 10 THEN '1.234' ELSE NULL END",
    "respondents_raw": f"CASE {_K} % 8 WHEN 0 THEN concat('O • ', CAST({_K} % 9 + 1 AS STRING), '.004') WHEN 1 THEN concat('TOM • 1.', CAST({_K} % 900 + 100 AS STRING), '25.02.–03.03.') WHEN 2 THEN concat('telefonisch ', CAST({_K} % 5000 AS STRING)) WHEN 3 THEN concat('Online-Panel ', CAST({_K} % 700 AS STRING)) WHEN 4 THEN 'TO • 1.204' WHEN 5 THEN 'face to face' WHEN 6 THEN '' ELSE 'komb. 1000' END",
    "institute_raw": f"CASE {_K} % 9 WHEN 0 THEN 'TNS  Emnid' WHEN 1 THEN 'forsa' WHEN 2 THEN 'Infratest Dimap' WHEN 3 THEN 'Forschungsgruppe Wahlen e.V.' WHEN 4 THEN 'YOUGOV' WHEN 5 THEN 'pollytix!' WHEN 6 THEN '  ' WHEN 7 THEN 'Nobody' ELSE NULL END",
    "method_raw": f"CASE {_K} % 8 WHEN 0 THEN 'CATI' WHEN 1 THEN 'Telefon & Online' WHEN 2 THEN 'Persönlich' WHEN 3 THEN '99' WHEN 4 THEN 'per Telefon und auch Online' WHEN 5 THEN 'nur online' WHEN 6 THEN 'TELEFON_ONLINE' ELSE 'andere' END",
    "scope_raw": f"CASE {_K} % 8 WHEN 0 THEN 'Bund' WHEN 1 THEN 'Bayern' WHEN 2 THEN 'NRW' WHEN 3 THEN 'Thüringen' WHEN 4 THEN 'eu' WHEN 5 THEN 'Ost' WHEN 6 THEN 'Baden-Württemberg' ELSE 'x' END",
    "election_raw": f"CASE {_K} % 3 WHEN 0 THEN 'Europawahl' WHEN 1 THEN 'Bundestagswahl' ELSE NULL END",
    "party_raw": f"CASE {_K} % 9 WHEN 0 THEN 'CDU/CSU' WHEN 1 THEN 'Grüne' WHEN 2 THEN ' die  Linke ' WHEN 3 THEN 'SPD!' WHEN 4 THEN 'Summe' WHEN 5 THEN 'Neue' WHEN 6 THEN 'And.' WHEN 7 THEN 'BVB/FW' ELSE 'Nichtwähler' END",
    "share_raw": f"CASE {_K} % 8 WHEN 0 THEN concat(CAST({_K} % 40 AS STRING), ',5 %') WHEN 1 THEN concat(CAST({_K} % 9 AS STRING), '–', CAST({_K} % 9 + 2 AS STRING)) WHEN 2 THEN '–' WHEN 3 THEN concat('BSW ', CAST({_K} % 7 AS STRING), ' %BP 1 %Sonst. 5 %') WHEN 4 THEN '' WHEN 5 THEN CAST({_K} % 50 AS STRING) WHEN 6 THEN 'k.A.' ELSE NULL END",
}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in RAW.items()])


RAW_SQL = "raw AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in RAW.items()) + " FROM orders)"
