"""Queries of the text transforms (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import survey as S
from ..operators import clean as C
from .derived import RAW_SQL, polls, raw, results, POLL, RESULT
from .registry import query


def kinds(n: int, values: list[str | None], column: str = "id") -> str:
    """The literal results of the n kinds of a derived raw column."""
    return f"CASE {column} % {n} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None) + " END"


PUBLISH = r"""coalesce(CASE WHEN regexp_matches(publish_raw, '^\d{4}-\d{2}-\d{2}') THEN CAST(try_strptime(substr(publish_raw, 1, 10), '%Y-%m-%d') AS DATE) END,
  CAST(try_strptime(replace(publish_raw, '. Januar ', '.01.'), '%d.%m.%Y') AS DATE))"""


def frame_sql(c: str, year: str) -> str:
    """CTE ``frames``: raw with (f_start, f_end, f_type, f_ignore) of column frame, as literal results of its twelve kinds."""
    date = lambda y, m, d: f"make_date(CAST({y} AS BIGINT), CAST({m} AS BIGINT), CAST({d} AS BIGINT))"
    y, m, d, e = "year(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)", "(day(o_orderdate) % 28 + 1)"
    return f"""frames AS (SELECT raw.*,
  CASE id % 12 WHEN 0 THEN {date(y, m, d)} WHEN 1 THEN {date(y, m, 1)} WHEN 2 THEN {date(y, m, 1)} WHEN 6 THEN {date(year, m, e)} WHEN 8 THEN {date(year, m, e)} END AS f_start,
  CASE id % 12 WHEN 0 THEN {date(y, m, e)} WHEN 1 THEN {date(y, m, e)} WHEN 2 THEN {date(y, m, e)} WHEN 6 THEN {date(year, m, 28)} END AS f_end,
  CASE WHEN id % 12 IN (0, 1, 2) THEN 'VALID_RANGE' WHEN id % 12 = 3 THEN 'TIME_RANGE' WHEN id % 12 = 4 THEN 'UNKNOWN_DATE' WHEN id % 12 = 5 THEN 'ELECTION_MARKER'
    WHEN {year} IS NULL THEN 'INVALID' WHEN id % 12 = 6 THEN 'VALID_RANGE' WHEN id % 12 = 7 THEN 'BIS_PREFIX' WHEN id % 12 = 8 THEN 'SINGLE_DATE' ELSE 'INVALID' END AS f_type,
  id % 12 IN (3, 4, 5) AS f_ignore FROM raw JOIN orders ON o_orderkey = id)"""


@query(f"WITH {RAW_SQL} SELECT id, {PUBLISH} AS publish_date FROM raw")
def c1_publish_date(spark, d):
    return raw(spark, d).select("id", S.publish_date(F.col("publish_raw")).alias("publish_date"))


_YEAR = "year(pub)"


@query(f"""WITH {RAW_SQL.replace('raw AS', 'raw0 AS')}, raw AS (SELECT *, {PUBLISH} AS pub FROM raw0), {frame_sql('frame', _YEAR)},
late AS (SELECT *, pub IS NOT NULL AND NOT regexp_matches(coalesce(frame, ''), '\\b\\d{{4}}\\b') AS yearless FROM frames),
moved AS (SELECT *, CASE WHEN yearless AND f_end > pub THEN CAST(f_start - INTERVAL 1 YEAR AS DATE) ELSE f_start END AS s, CASE WHEN yearless AND f_end > pub THEN CAST(f_end - INTERVAL 1 YEAR AS DATE) ELSE f_end END AS e FROM late)
SELECT id, CASE WHEN NOT f_ignore THEN CASE WHEN yearless AND s > e THEN CAST(s - INTERVAL 1 YEAR AS DATE) ELSE s END END AS survey_start, CASE WHEN NOT f_ignore THEN e END AS survey_end, f_ignore AS ignored FROM moved""")
def c2_survey_window(spark, d):
    none = F.lit(None).cast("string")
    w = S.survey_window(none, none, F.col("frame"), S.publish_date(F.col("publish_raw")))
    return raw(spark, d).select("id", w.alias("w")).select("id", F.col("w.start").alias("survey_start"), F.col("w.end").alias("survey_end"), F.col("w.ignore").alias("ignored"))


@query(f"""WITH {RAW_SQL}, moved AS (SELECT id, CAST(o_orderdate AS DATE) AS s0, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) - 200 AS DATE) AS e0, CAST(CAST(o_orderdate AS DATE) + 3 AS DATE) AS pub FROM raw JOIN orders ON id = o_orderkey),
a AS (SELECT *, CASE WHEN e0 > pub THEN CAST(s0 - INTERVAL 1 YEAR AS DATE) ELSE s0 END AS s, CASE WHEN e0 > pub THEN CAST(e0 - INTERVAL 1 YEAR AS DATE) ELSE e0 END AS e FROM moved)
SELECT id, CASE WHEN s > e THEN CAST(s - INTERVAL 1 YEAR AS DATE) ELSE s END AS survey_start, e AS survey_end FROM a""")
def c3_year_repair(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("s"))
    r = S.repaired(F.col("s"), F.date_add("s", (F.col("id") % 400 - 200).cast("int")), F.date_add("s", 3), F.lit("01.02.–03.02."))
    return o.select("id", r["start"].alias("survey_start"), r["end"].alias("survey_end"))


@query(f"WITH {RAW_SQL.replace('raw AS', 'raw0 AS')}, raw AS (SELECT *, 2001 AS y FROM raw0), {frame_sql('frame', 'y')} SELECT id, f_start AS frame_start, f_end AS frame_end, f_type AS frame_type, f_ignore AS ignored FROM frames")
def c4_timeframe(spark, d):
    return raw(spark, d).select("id", S.timeframe(F.col("frame"), F.lit(2001)).alias("w")).select("id", F.col("w.start").alias("frame_start"), F.col("w.end").alias("frame_end"), F.col("w.type").alias("frame_type"), F.col("w.ignore").alias("ignored"))


@query(f"WITH {RAW_SQL}, {frame_sql('frame', 'CAST(NULL AS BIGINT)')} SELECT id, frame, f_start AS frame_start, f_end AS frame_end, f_type AS frame_type, f_ignore AS ignored FROM frames")
def c5_timeframe_step(spark, d):
    return raw(spark, d).select("id", "frame", S.timeframe(F.col("frame")).alias("w")).select("id", "frame", F.col("w.start").alias("frame_start"), F.col("w.end").alias("frame_end"), F.col("w.type").alias("frame_type"), F.col("w.ignore").alias("ignored"))


#: Literal results of the eight kinds of respondents_raw.
COUNT = "CAST(CASE id % 8 WHEN 0 THEN (id % 9 + 1) * 1000 + 4 WHEN 1 THEN 1000 + id % 900 + 100 WHEN 2 THEN id % 5000 WHEN 3 THEN id % 700 WHEN 4 THEN 1204 WHEN 7 THEN 1000 END AS INT)"
METHOD = "CASE id % 8 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'TELEFON_ONLINE' WHEN 2 THEN 'TELEFONISCH' WHEN 3 THEN 'ONLINE' WHEN 4 THEN 'TELEFON_ONLINE' WHEN 5 THEN 'PERSOENLICH' WHEN 7 THEN 'TELEFON_ONLINE' END"


def RANGE_AT(i: int) -> str:
    return f"CASE WHEN id % 8 = 1 THEN make_date(year({PUBLISH}), {2 if i == 1 else 3}, {25 if i == 1 else 3}) END"


@query(f"WITH {RAW_SQL} SELECT id, {COUNT} AS respondents FROM raw")
def c6_respondents(spark, d):
    return raw(spark, d).select("id", S.respondents(F.col("respondents_raw")).alias("respondents"))


@query(f"WITH {RAW_SQL} SELECT id, {METHOD} AS method FROM raw")
def c7_method_hint(spark, d):
    return raw(spark, d).select("id", S.method_hint(F.col("respondents_raw")).alias("method"))


@query(f"WITH {RAW_SQL} SELECT id, {RANGE_AT(1)} AS range_start, {RANGE_AT(2)} AS range_end FROM raw")
def c8_embedded_range(spark, d):
    return raw(spark, d).select("id", S.embedded_range(F.col("respondents_raw"), S.publish_date(F.col("publish_raw"))).alias("r")).select("id", F.col("r.start").alias("range_start"), F.col("r.end").alias("range_end"))


@query(f"""WITH {RAW_SQL} SELECT id, CASE id % 8 WHEN 5 THEN 'Could not extract count from ''face to face''' WHEN 6 THEN 'Empty or invalid input' END AS problem FROM raw""")
def c9_parse_diagnostics(spark, d):
    return raw(spark, d).select("id", S.parse_diagnostics(F.col("respondents_raw")).alias("problem"))


@query(f"""WITH {RAW_SQL} SELECT id, CASE WHEN id % 24 = 22 THEN '1.234' ELSE respondents_raw END AS respondents, CASE WHEN id % 24 <> 22 THEN frame END AS frame FROM raw""")
def c10_swapped_fields(spark, d):
    return raw(spark, d).select("id", S.unswapped(F.col("respondents_raw"), F.col("frame")).alias("x")).select("id", F.col("x.respondents").alias("respondents"), F.col("x.timeframe").alias("frame"))


_NORMAL = ["cdu/csu", "grüne", "die linke", "spd!", "summe", "neue", "and.", "bvb/fw", "nichtwähler"]
_SIMPLE = ["cdu/csu", "grüne", "die linke", "spd", "summe", "neue", "and", "bvb/fw", "nichtwähler"]


@query(f"WITH {RAW_SQL} SELECT id, {kinds(9, _NORMAL)} AS normal, {kinds(9, _SIMPLE)} AS simple FROM raw")
def c11_labels(spark, d):
    return raw(spark, d).select("id", S.label(F.col("party_raw")).alias("normal"), S.simple_label(F.col("party_raw"), "/").alias("simple"))


_INSTITUTE = ["VERIAN", "FORSA", "INFRATEST", "FORSCHUNGSGRUPPE_WAHLEN", "YOUGOV", "POLLYTIX", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


@query(f"WITH {RAW_SQL} SELECT id, {kinds(9, _INSTITUTE)} AS institute FROM raw")
def c12_institute(spark, d):
    return raw(spark, d).select("id", S.institute(F.col("institute_raw")).alias("institute"))


_METHOD = ["TELEFONISCH", "TELEFON_ONLINE", "PERSOENLICH", "UNBEKANNT", "TELEFON_ONLINE", "ONLINE", "TELEFON_ONLINE", "UNBEKANNT"]


@query(f"WITH {RAW_SQL} SELECT id, {kinds(8, _METHOD)} AS method FROM raw")
def c13_method(spark, d):
    return raw(spark, d).select("id", S.method(F.col("method_raw")).alias("method"))


STATE = kinds(8, ["BUND", "BY", "NW", "TH", "BUND", "OST", "BW", "BUND"])
_CODE = kinds(8, ["federal", "by", "nrw", "th", "federal", "ost", "bw", "federal"])


@query(f"WITH {RAW_SQL} SELECT id, {STATE} AS key, {_CODE} AS code FROM raw")
def c14_scope(spark, d):
    return raw(spark, d).select("id", S.state(F.col("scope_raw")).alias("key"), S.scope_code(F.col("scope_raw")).alias("code"))


@query(f"""WITH {RAW_SQL} SELECT id, CASE WHEN id % 3 = 0 THEN 'EU_WAHLEN' ELSE {STATE} END AS key, CASE WHEN id % 3 = 0 THEN 'Europawahl' WHEN id % 8 IN (0, 4, 5, 7) THEN 'Bundestagswahl' ELSE 'Landtagswahl' END AS type,
CASE WHEN id % 3 = 0 THEN 'eu' ELSE {_CODE} END AS scope FROM raw""")
def c15_election(spark, d):
    return raw(spark, d).select("id", S.election(F.col("scope_raw"), F.col("election_raw")).alias("e")).select("id", "e.*")


_PARTY = kinds(9, ["CDU_CSU", "GRUENE", "LINKE", "SPD", None, None, "SONSTIGE", "BVB_FW"])


@query(f"WITH {RAW_SQL} SELECT id, {_PARTY} AS party, id % 9 IN (4, 8) AS no_result FROM raw")
def c16_party(spark, d):
    return raw(spark, d).select("id", S.party(F.col("party_raw")).alias("party"), S.is_non_result(F.col("party_raw")).alias("no_result"))


#: Literal results of the eight kinds of share_raw.
SHARE = "CAST(CASE id % 8 WHEN 0 THEN id % 40 + 0.5 WHEN 1 THEN id % 9 + 1 WHEN 3 THEN id % 7 + 6 WHEN 5 THEN id % 50 END AS DOUBLE)"


@query(f"WITH {RAW_SQL} SELECT id, {SHARE} AS percentage FROM raw")
def c17_percentage(spark, d):
    return raw(spark, d).select("id", S.percentage(F.col("share_raw")).alias("percentage"))


_ENTRIES = """CASE id % 5 WHEN 0 THEN ' ' WHEN 1 THEN '["SPD"]' ELSE to_json(map_from_arrays(array('SPD', 'cdu', 'Summe', 'Neue', 'FDP', 'spd'), array(concat(CAST(id % 40 AS STRING), ',5 %'), CAST(id % 30 AS STRING), '100', '3', 'k.A.', '7'))) END"""


@query(f"""WITH {RAW_SQL}, e AS (SELECT id, unnest(['SPD', 'cdu', 'Summe', 'Neue', 'FDP', 'spd']) AS label, unnest(['SPD', 'CDU', NULL, NULL, NULL, 'SPD']) AS party, unnest([id % 40 + 0.5, CAST(id % 30 AS DOUBLE), NULL, NULL, NULL, 7.0]) AS percentage,
  unnest(['ok', 'ok', 'skipped', 'unknown party', 'unparseable value', 'duplicate party']) AS outcome, unnest([0, 1, 2, 3, 4, 5]) AS pos FROM raw WHERE id % 5 > 1)
SELECT id, CAST(pos AS INT) AS pos, label, party, CAST(percentage AS DOUBLE) AS percentage, outcome FROM e UNION ALL SELECT id, NULL, NULL, NULL, NULL, CASE id % 5 WHEN 0 THEN 'empty payload' ELSE 'no JSON object' END FROM raw WHERE id % 5 <= 1""")
def c18_party_json(spark, d):
    return C.explode_parties(raw(spark, d).select("id", F.expr(_ENTRIES).alias("parties")))


@query(f"""WITH {RAW_SQL} SELECT id, CASE WHEN id % 5 > 1 THEN concat('CDU=', CAST(id % 30 AS VARCHAR), ',SPD=7') END AS results, CASE WHEN id % 5 > 1 THEN 3 ELSE 1 END AS n_failed, false AS complete FROM raw""")
def c18_party_results(spark, d):
    r = C.party_results(C.explode_parties(raw(spark, d).select("id", F.expr(_ENTRIES).alias("parties"))))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("results")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("int").cast("string"))), ",")
    return r.select("id", text.alias("results"), "n_failed", "complete")


FIELDS = ("election", "institute", "method", "provider", "publish_date", "respondents", "scope", "source", "survey_end", "survey_start")
FINGERPRINT = f"""{POLL}, {RESULT}, listed AS (SELECT poll_id, list({{'party': party, 'value': CAST(round(percentage * 1000) AS BIGINT)}} ORDER BY party) AS results FROM result GROUP BY 1),
fp AS (SELECT id, CASE WHEN results IS NOT NULL THEN sha256(CAST(to_json({{{', '.join(f"'{c}': {c}" for c in FIELDS)}, 'results': results}}) AS VARCHAR)) END AS fingerprint FROM poll LEFT JOIN listed ON poll_id = id)"""


def fingerprints(polls_df, results_df):
    from ..operators.dedupe import fingerprint
    from ..operators.views import nested_results

    rows = polls_df.join(nested_results(results_df), F.col("id") == F.col("poll_id"), "left")
    return rows.withColumn("fingerprint", fingerprint({c: F.col(c) for c in FIELDS}, F.col("results")))


@query(f"WITH {FINGERPRINT} SELECT id, fingerprint FROM fp")
def c19_fingerprint(spark, d):
    return fingerprints(polls(spark, d), results(spark, d)).select("id", "fingerprint")


@query(f"WITH {RAW_SQL} SELECT id, CAST(TRY_CAST(CASE WHEN publish_raw LIKE '%T%Z' THEN replace(publish_raw, 'Z', '') WHEN publish_raw LIKE '____-%' THEN publish_raw END AS TIMESTAMP) AS DATE) AS day FROM raw")
def c20_timestamp(spark, d):
    return raw(spark, d).select("id", S.timestamp(F.col("publish_raw")).cast("date").alias("day"))


@query(f"WITH {RAW_SQL}, s AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'EU_WAHLEN' ELSE {STATE} END AS k, election_raw FROM raw) SELECT id, CASE k WHEN 'BUND' THEN 'federal' WHEN 'EU_WAHLEN' THEN 'european' WHEN 'NW' THEN 'nrw' ELSE lower(k) END AS election, CASE election_raw WHEN 'Europawahl' THEN 'European election' WHEN 'Bundestagswahl' THEN 'Federal election' END AS name FROM s")
def c21_public_names(spark, d):
    e = S.election(F.col("scope_raw"), F.col("election_raw"))
    return raw(spark, d).select("id", S.public_election_key(e["key"]).alias("election"), S.public_election_name(F.col("election_raw")).alias("name"))
