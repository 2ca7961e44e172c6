"""Queries of matching, selection and validation (E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match as M, select as P, validate as V
from .derived import MATCH_TABLES, POLL, RESULT, match_tables, polls, results
from .registry import query

CFG = M.MatchConfig(parties=("1", "2"), max_party_delta=10, max_total_delta=15)

_SIDES = f"""{MATCH_TABLES},
wide AS (SELECT poll_id, max(CASE WHEN party = '1' THEN percentage END) AS p0, max(CASE WHEN party = '2' THEN percentage END) AS p1 FROM mresult WHERE party IN ('1', '2') GROUP BY 1),
side AS (SELECT m.*, p0, p1, p0 IS NOT NULL AND p1 IS NOT NULL AS complete FROM mpoll m LEFT JOIN wide ON poll_id = id WHERE publish_date IS NOT NULL)"""
_PAIRS = f"""{_SIDES},
near AS (SELECT a.id AS a_id, b.id AS b_id, abs(a.p0 - b.p0) AS d0, abs(a.p1 - b.p1) AS d1, abs(date_diff('day', a.publish_date, b.publish_date)) AS days, a.survey_start AS as_, a.survey_end AS ae, b.survey_start AS bs, b.survey_end AS be, a.respondents AS ar, b.respondents AS br
  FROM side a JOIN side b ON a.provider = 'primary' AND b.provider = 'secondary' AND a.complete AND b.complete AND a.scope IS NOT DISTINCT FROM b.scope AND a.institute IS NOT DISTINCT FROM b.institute AND (coalesce(a.election, '') = coalesce(b.election, '') OR coalesce(a.election, '') = '' OR coalesce(b.election, '') = '') AND abs(date_diff('day', a.publish_date, b.publish_date)) <= 7),
pairs AS (SELECT *, d0 + d1 AS total, d0 + d1 + 0.1 * days AS score FROM near WHERE greatest(d0, d1) <= 10 AND d0 + d1 <= 15)"""
_DATED = f"""{_PAIRS},
dated AS (SELECT * FROM (SELECT *, max(CASE WHEN as_ IS NOT NULL AND ae IS NOT NULL AND bs IS NOT NULL AND be IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY a_id) AS strict FROM pairs) WHERE strict = 0 OR coalesce(as_ = bs AND ae = be, false))"""
_KEPT = f"""{_DATED},
kept AS (SELECT * FROM (SELECT *, max(CASE WHEN ar IS NOT NULL AND br IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY a_id) AS rstrict FROM dated) WHERE rstrict = 0 OR coalesce(ar = br, false))"""
_CHOSEN = f"""{_KEPT},
ranked AS (SELECT *, row_number() OVER w AS rank, lead(score) OVER w - score AS gap FROM kept WINDOW w AS (PARTITION BY a_id ORDER BY score, b_id)),
best AS (SELECT *, rank = 1 AND (gap IS NULL OR gap >= 0.01) AS best FROM ranked),
taken AS (SELECT *, sum(CASE WHEN best THEN 1 ELSE 0 END) OVER (PARTITION BY b_id) AS n FROM best),
chosen AS (SELECT *, best AND n > 1 AS collision, best AND n = 1 AS chosen FROM taken)"""
_LINKS = f"""{_CHOSEN},
settled AS (SELECT *, max(CASE WHEN chosen THEN 1 ELSE 0 END) OVER (PARTITION BY a_id) = 1 AS settled FROM chosen),
of_a AS (SELECT a_id, max(CASE WHEN chosen THEN b_id END) AS m FROM settled GROUP BY 1),
of_b AS (SELECT b_id, max(CASE WHEN chosen THEN a_id END) AS m, bool_or(NOT settled) AS ambiguous FROM settled GROUP BY 1),
links AS (SELECT id, 'primary' AS side, CASE WHEN NOT complete THEN 'missing_results' WHEN a_id IS NULL THEN 'no_match' WHEN m IS NULL THEN 'multiple_matches' ELSE 'matched' END AS status, m AS matched_id FROM side LEFT JOIN of_a ON id = a_id WHERE provider = 'primary'
UNION ALL SELECT id, 'secondary', CASE WHEN NOT complete THEN 'missing_results' WHEN ambiguous THEN 'multiple_matches' WHEN m IS NOT NULL THEN 'matched' ELSE 'no_match' END, CASE WHEN NOT coalesce(ambiguous, false) THEN m END FROM side LEFT JOIN of_b ON id = b_id WHERE provider = 'secondary')"""


def sides(spark, d):
    p, r = match_tables(spark, d)
    return M.side(p, r, "PRIMARY", CFG), M.side(p, r, "Secondary", CFG)


def pairs(spark, d):
    return M.candidates(*sides(spark, d), CFG)


def links(spark, d):
    return M.link_all(*match_tables(spark, d), CFG, "PRIMARY", "Secondary")


@query(f"WITH {_SIDES} SELECT id, provider, p0, p1, complete FROM side")
def e1_sides(spark, d):
    a, b = sides(spark, d)
    return a.unionByName(b).select("id", "provider", "p0", "p1", "complete")


@query(f"WITH {_PAIRS} SELECT a_id, b_id, CAST(days AS BIGINT) AS days FROM near")
def e2_interval_candidates(spark, d):
    wide = M.MatchConfig(parties=("1", "2"), max_party_delta=1000, max_total_delta=2000)
    rows = M.candidates(*sides(spark, d), wide)
    return rows.select("a_id", "b_id", F.abs(F.datediff("a_publish_date", "b_publish_date")).cast("long").alias("days"))


@query(f"WITH {_PAIRS} SELECT a_id, b_id, total, score FROM pairs")
def e3_scored_pairs(spark, d):
    return pairs(spark, d).select("a_id", "b_id", "total", "score")


@query(f"WITH {_DATED} SELECT a_id, b_id FROM dated")
def e4_date_evidence(spark, d):
    import dataclasses

    return M.with_evidence(pairs(spark, d), dataclasses.replace(CFG, respondent_tolerance=10**9)).select("a_id", "b_id")


@query(f"WITH {_KEPT} SELECT a_id, b_id FROM kept")
def e5_respondent_evidence(spark, d):
    return M.with_evidence(pairs(spark, d), CFG).select("a_id", "b_id")


@query(f"WITH {_CHOSEN} SELECT a_id, b_id, CAST(rank AS BIGINT) AS rank, best FROM chosen")
def e6_unique_best(spark, d):
    return M.choose(M.with_evidence(pairs(spark, d), CFG), CFG).select("a_id", "b_id", F.col("rank").cast("long").alias("rank"), "best")


@query(f"WITH {_CHOSEN} SELECT a_id, b_id, collision, chosen FROM chosen WHERE best")
def e7_collisions(spark, d):
    return M.choose(M.with_evidence(pairs(spark, d), CFG), CFG).filter("best").select("a_id", "b_id", "collision", "chosen")


@query(f"WITH {_LINKS} SELECT id, side, status, matched_id FROM links")
def e8_links(spark, d):
    return links(spark, d)


@query(f"""WITH {_LINKS} SELECT count(*) FILTER (status = 'matched' AND side = 'primary') AS matched, count(*) FILTER (status = 'no_match') AS no_match, count(*) FILTER (status = 'multiple_matches' AND side = 'primary') AS multiple_matches, count(*) FILTER (status = 'missing_results') AS missing_results FROM links""")
def e9_match_statistics(spark, d):
    return M.match_statistics(links(spark, d))


SEL = P.SelectionConfig(cutoff_year=1998)
_STATUS = "CASE id % 5 WHEN 0 THEN 'no_match' WHEN 1 THEN 'multiple_matches' WHEN 2 THEN 'matched' WHEN 3 THEN 'missing_results' END"
_SELECTED = f"""{POLL}, st AS (SELECT *, {_STATUS} AS status FROM poll),
sel AS (SELECT *, CASE WHEN year(publish_date) < 1998 THEN CASE WHEN provider <> 'historic' THEN 'non_primary_provider_before_cutoff' END WHEN provider = 'primary' THEN NULL
 WHEN provider = 'secondary' THEN CASE status WHEN 'no_match' THEN NULL WHEN 'multiple_matches' THEN 'ambiguous_secondary_match' WHEN 'matched' THEN 'matched_secondary_provider' ELSE 'secondary_match_not_resolved' END ELSE 'non_public_provider_after_cutoff' END AS reason FROM st)"""


def selected(spark, d):
    return P.select_public(polls(spark, d).withColumn("status", F.expr(_STATUS)), SEL)


@query(f"WITH {_SELECTED} SELECT id, reason, reason IS NULL AS is_public FROM sel")
def f1_provider_priority(spark, d):
    return selected(spark, d).select("id", "reason", "is_public")


@query(f"WITH {_SELECTED} SELECT id, status, CASE status WHEN 'no_match' THEN NULL WHEN 'multiple_matches' THEN 'ambiguous_secondary_match' WHEN 'matched' THEN 'matched_secondary_provider' ELSE 'secondary_match_not_resolved' END AS reason FROM st WHERE provider = 'secondary'")
def f2_secondary_decision(spark, d):
    rows = polls(spark, d).withColumn("status", F.expr(_STATUS)).filter("provider = 'secondary'")
    return rows.select("id", "status", P.secondary_reason(F.coalesce("status", F.lit("")), SEL).alias("reason"))


@query(f"WITH {_SELECTED} SELECT coalesce(reason, 'public') AS reason, count(*) AS n FROM sel GROUP BY 1")
def f3_selection_counts(spark, d):
    return P.selection_counts(selected(spark, d))


@query(f"WITH {_SELECTED} SELECT id FROM sel WHERE reason IS NULL AND ((id % 4 <> 0 AND id % 3 <> 0) OR (provider = 'historic' AND year(publish_date) < 1998))")
def f4_serving_gate(spark, d):
    p = selected(spark, d)
    checks = p.filter("id % 4 <> 0").select(F.col("id").alias("poll_id"), (F.col("id") % 3 != 0).alias("valid"), F.lit(0).alias("warning_count"))
    return P.serving_gate(p, checks, P.GatePolicy(cutoff_year=1998)).select("id")


BASE = f"{POLL}, {RESULT}"
BOUNDS = [("1-URGENT", 700, 4000), ("2-HIGH", 500, 3000), ("3-MEDIUM", 500, 4500), ("4-NOT SPECIFIED", 700, 4000), ("5-LOW", 500, 3000)]
RULES = [("*", ["1", "2"], None, None), ("even", ["3"], 1997, None), ("scope7", ["4", "5"], None, 2000)]
TODAY = "2001-01-01"
G1 = "g1 AS (SELECT id, coalesce(count(poll_id) > 0 AND count(*) FILTER (WHERE percentage > 45) = 0, false) AS passed, coalesce(string_agg(CASE WHEN percentage > 45 THEN party END, ',' ORDER BY party), '') AS offenders FROM poll LEFT JOIN result ON poll_id = id GROUP BY id)"
G2 = "g2 AS (SELECT id, coalesce(sum(percentage) BETWEEN 98 AND 102, false) AS passed, sum(percentage) AS observed FROM poll LEFT JOIN result ON poll_id = id GROUP BY id)"
G3 = f"g3 AS (SELECT id, CASE WHEN survey_start IS NULL OR survey_end IS NULL OR publish_date IS NULL THEN 'missing dates' WHEN NOT (survey_start <= survey_end AND survey_end <= publish_date) THEN 'dates out of order' WHEN publish_date > DATE '{TODAY}' THEN 'date in the future' ELSE 'ok' END AS message FROM poll)"
G4 = "g4 AS (SELECT id, coalesce(respondents BETWEEN low AND high, false) AS passed FROM poll LEFT JOIN (VALUES " + ", ".join(f"('{m}', {a}, {b})" for m, a, b in BOUNDS) + ") AS b(m, low, high) ON m = method)"
G5 = """g5 AS (SELECT id, unnest(['1', '2']) AS party FROM poll UNION SELECT id, '3' FROM poll WHERE scope % 2 = 0 AND year(publish_date) >= 1997 UNION SELECT id, unnest(['4', '5']) FROM poll WHERE scope = 7 AND year(publish_date) <= 2000)"""
G6 = """grid AS (SELECT id, scope, publish_date, party, id IN (SELECT poll_id FROM result r WHERE r.party = m.party) AS has FROM poll, (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) AS m(party)),
g6 AS (SELECT id, party, CAST(has AS INT) AS has, count(*) OVER w - 1 AS comparisons, CAST(sum(CAST(has AS INT)) OVER w AS BIGINT) - CAST(has AS INT) AS with_party FROM grid WINDOW w AS (PARTITION BY scope, party ORDER BY publish_date RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND INTERVAL 365 DAY FOLLOWING))"""
G7 = f"""{G5}, {G6}, miss AS (SELECT g5.id, g5.party, comparisons >= 5 AND with_party >= 0.8 * comparisons AS block FROM g5 JOIN g6 ON g5.id = g6.id AND g5.party = g6.party WHERE has = 0),
g7 AS (SELECT poll.id, coalesce(string_agg(CASE WHEN block THEN party END, ',' ORDER BY party), '') AS blocking, coalesce(string_agg(CASE WHEN NOT block THEN party END, ',' ORDER BY party), '') AS context FROM poll LEFT JOIN miss ON miss.id = poll.id GROUP BY poll.id)"""


def jump_sql(name: str, group: str) -> str:
    return f"""{name}d AS (SELECT id, abs(percentage - lag(percentage) OVER (PARTITION BY {group}, party ORDER BY publish_date NULLS FIRST, id)) AS delta FROM poll JOIN result ON poll_id = id),
{name} AS (SELECT poll.id, count(delta) AS jumps, max(delta) AS largest FROM poll LEFT JOIN (SELECT * FROM {name}d WHERE delta > 25) j ON j.id = poll.id GROUP BY poll.id)"""


def expected(spark, p):
    return V.expected_parties(p, RULES, group_of())


MONITORED = ["1", "2", "3", "4", "5"]


@query(f"WITH {BASE}, {G1} SELECT * FROM g1")
def g1_range_check(spark, d):
    return V.range_check(polls(spark, d), results(spark, d), 0, 45)


@query(f"WITH {BASE}, {G2} SELECT * FROM g2")
def g2_sum_check(spark, d):
    return V.sum_check(polls(spark, d), results(spark, d))


@query(f"WITH {BASE}, {G3} SELECT id, message = 'ok' AS passed, message FROM g3")
def g3_date_check(spark, d):
    return V.date_check(polls(spark, d), F.lit(TODAY).cast("date"))


def bounds(spark):
    return spark.createDataFrame(BOUNDS, "method string, low int, high int")


@query(f"WITH {BASE}, {G4} SELECT * FROM g4")
def g4_respondents_check(spark, d):
    return V.respondents_check(polls(spark, d), bounds(spark), "3-MEDIUM")


@query(f"WITH {BASE}, {G5} SELECT * FROM g5")
def g5_expected_parties(spark, d):
    return expected(spark, polls(spark, d))


@query(f"WITH {BASE}, {G6} SELECT * FROM g6")
def g6_nearby_presence(spark, d):
    return V.presence(polls(spark, d), results(spark, d), MONITORED)


def core(spark, d):
    p = polls(spark, d)
    return V.core_party_check(p, expected(spark, p), V.presence(p, results(spark, d), MONITORED))


@query(f"WITH {BASE}, {G7} SELECT id, blocking = '' AS passed, CASE WHEN blocking <> '' THEN 'error' WHEN context <> '' THEN 'warning' ELSE 'info' END AS severity, blocking, context FROM g7")
def g7_core_parties(spark, d):
    return core(spark, d)


@query(f"WITH {BASE}, {jump_sql('g8', 'institute')} SELECT id, jumps = 0 AS passed, jumps, largest FROM g8")
def g8_institute_jumps(spark, d):
    return V.jump_check(polls(spark, d), results(spark, d), "institute", 25)


@query(f"WITH {BASE}, {jump_sql('g9', 'scope')} SELECT id, jumps = 0 AS passed, jumps, largest FROM g9")
def g9_scope_jumps(spark, d):
    return V.jump_check(polls(spark, d), results(spark, d), "scope", 25)


_FLAGS = f"""{BASE}, {G1}, {G2}, {G3}, {G4}, {G7}, {jump_sql('g8', 'institute')}, {jump_sql('g9', 'scope')},
flags AS (SELECT g1.id AS poll_id, g1.passed AS qc_range, g2.passed AS qc_sum, message = 'ok' AS qc_dates, g4.passed AS qc_respondents, blocking = '' AS qc_core, g8.jumps = 0 AS qc_jump_institute, g9.jumps = 0 AS qc_jump_scope, observed AS observed_sum, offenders, blocking, g8.jumps + g9.jumps AS jumps
  FROM g1 JOIN g2 USING (id) JOIN g3 USING (id) JOIN g4 USING (id) JOIN g7 USING (id) JOIN g8 USING (id) JOIN g9 USING (id)),
val AS (SELECT *, qc_range AND qc_dates AND qc_respondents AS valid, CAST(NOT qc_range AS BIGINT) + CAST(NOT qc_sum AS BIGINT) + CAST(NOT qc_dates AS BIGINT) + CAST(NOT qc_respondents AS BIGINT) + CAST(NOT qc_core AS BIGINT) AS error_count,
  CAST(NOT qc_jump_institute AS BIGINT) + CAST(NOT qc_jump_scope AS BIGINT) AS warning_count FROM flags)"""
REQUIRED = ["qc_range", "qc_dates", "qc_respondents"]


def group_of():
    return F.concat(F.lit("|"), F.when(F.col("scope") % 2 == 0, "even").otherwise("odd"), F.lit("|scope"), F.col("scope").cast("string"), F.lit("|"))


def flags(spark, d):
    return V.check_flags(polls(spark, d), results(spark, d), bounds(spark), "3-MEDIUM", RULES, group_of(), MONITORED, F.lit(TODAY).cast("date"), V.CheckConfig(high=45, jump=25))


def validations(spark, d):
    return V.validation_rows(flags(spark, d), REQUIRED)


@query(f"WITH {_FLAGS} SELECT poll_id, valid FROM val")
def g10_research_ready(spark, d):
    return flags(spark, d).select("poll_id", V.research_ready(REQUIRED).alias("valid"))


@query(f"""WITH {_FLAGS} SELECT poll_id, valid, error_count, warning_count, qc_range, qc_sum, qc_dates, qc_respondents, qc_core, qc_jump_institute, qc_jump_scope,
CAST(to_json({{'observed_sum': CAST(observed_sum AS DOUBLE), 'offenders': offenders, 'blocking': blocking, 'jumps': jumps}}) AS VARCHAR) AS details FROM val""")
def g11_validation_rows(spark, d):
    """The rows of a run over all polls take the place of earlier ones."""
    new = validations(spark, d)
    old = polls(spark, d).filter("id % 2 = 0").select(F.col("id").alias("poll_id"), F.lit(False).alias("valid"), *[F.lit(9).cast("long").alias(c) for c in ("error_count", "warning_count")], *[F.lit(False).alias(c) for c in V.CHECKS], F.lit("").alias("details"))
    rows = V.upsert_validations(old, new)
    at = lambda path: F.get_json_object("details", f"$.{path}")
    parties = lambda c: F.coalesce(F.array_join(F.from_json(at(f"{c}.affected_parties"), "array<string>"), ","), F.lit(""))
    jumps = sum(F.size(F.from_json(at(f"{c}.affected_parties"), "array<string>")) for c in V.CHECKS[5:])
    blocking = F.when(at("qc_core.passed") == "false", parties("qc_core")).otherwise("")
    told = F.struct(F.when(at("qc_range.observed") != "{}", at("qc_sum.observed").cast("double")).alias("observed_sum"), parties("qc_range").alias("offenders"), blocking.alias("blocking"), jumps.cast("long").alias("jumps"))
    return rows.withColumn("details", F.to_json(told, {"ignoreNullFields": "false"}))


_NUMBERS = "CASE WHEN percentage = floor(percentage) THEN printf('%.1f', percentage) ELSE CAST(percentage AS VARCHAR) END"


def _jumps_sql(name: str, group: str, said: str) -> str:
    return f"""{name}l AS (SELECT id, party, percentage, lag(percentage) OVER w AS before, lag(id) OVER w AS before_id FROM poll JOIN result ON poll_id = id WINDOW w AS (PARTITION BY {group}, party ORDER BY publish_date NULLS FIRST, id)),
{name}j AS (SELECT id, string_agg(party, ',' ORDER BY party) AS affected, '[' || string_agg(printf('{{"current":%.1f,"jump":%.1f,"party_key":"%s","previous":%.1f,"previous_poll_id":%d,"previous_public_id":"C%08d"}}', percentage, percentage - before, party, before, before_id, before_id), ',' ORDER BY party) || ']' AS observed
  FROM {name}l WHERE abs(percentage - before) > 25 GROUP BY id),
{name}s AS (SELECT p.id, j.id IS NULL AS passed, 'warning' AS severity, coalesce(observed, '[]') AS observed, 'No party jump greater than 25 percentage points.' AS expected, CASE WHEN j.id IS NOT NULL THEN 'Large party result jump within same {said}.' END AS message, coalesce(affected, '') AS affected FROM poll p LEFT JOIN {name}j j ON j.id = p.id)"""


@query(f"""WITH {BASE}, {G3}, {G7}, {_jumps_sql('i', 'institute', 'institute')}, {_jumps_sql('s', 'scope', 'scope')},
told0 AS (SELECT poll_id, '{{' || string_agg('"' || party || '":' || {_NUMBERS}, ',' ORDER BY party) || '}}' AS shares, '[' || string_agg('"' || party || '"', ',' ORDER BY party) || ']' AS have, coalesce(string_agg(CASE WHEN percentage > 45 THEN party END, ',' ORDER BY party), '') AS outside, sum(percentage) AS total FROM result GROUP BY 1),
told AS (SELECT id AS poll_id, coalesce(shares, '{{}}') AS shares, coalesce(have, '[]') AS have, coalesce(outside, '') AS outside, coalesce(total, 0) AS total, shares IS NOT NULL AS held FROM poll LEFT JOIN told0 ON told0.poll_id = id),
wanted AS (SELECT id, string_agg(party, ', ' ORDER BY party) AS wanted FROM g5 GROUP BY 1),
b AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {lo}, {hi})" for m, lo, hi in BOUNDS)}) AS b(method, low, high)),
range_ AS (SELECT id, held AND outside = '' AS passed, 'error' AS severity, shares AS observed, 'Each party percentage must be between 0 and 45.' AS expected, CASE WHEN NOT held OR outside <> '' THEN 'One or more party percentages are outside the allowed range.' END AS message, outside AS affected FROM poll JOIN told ON poll_id = id),
sum_ AS (SELECT id, total BETWEEN 98 AND 102 AS passed, 'error' AS severity, printf('%.1f', total) AS observed, 'Sum between 98 and 102.' AS expected, CASE WHEN total NOT BETWEEN 98 AND 102 THEN 'Party results do not sum to 100 within tolerance.' END AS message, '' AS affected FROM poll JOIN told ON poll_id = id),
dates AS (SELECT p.id, g3.message = 'ok' AS passed, 'error' AS severity, '{{"publish_date":"' || publish_date || '","survey_date_end":' || coalesce('"' || survey_end || '"', 'null') || ',"survey_date_start":' || coalesce('"' || survey_start || '"', 'null') || '}}' AS observed,
  'survey_date_start <= survey_date_end <= publish_date; no future dates.' AS expected, CASE g3.message WHEN 'ok' THEN NULL WHEN 'missing dates' THEN 'One or more required dates are missing.' ELSE 'Poll dates are inconsistent or in the future.' END AS message, '' AS affected FROM poll p JOIN g3 ON g3.id = p.id),
asked AS (SELECT id, respondents BETWEEN low AND high AS passed, 'error' AS severity, CAST(respondents AS VARCHAR) AS observed, method || ': respondents between ' || low || ' and ' || high || '.' AS expected, CASE WHEN respondents NOT BETWEEN low AND high THEN 'Respondent count is missing or outside plausible range.' END AS message, '' AS affected FROM poll JOIN b USING (method)),
core_ AS (SELECT poll.id, blocking = '' AS passed, CASE WHEN blocking = '' AND context <> '' THEN 'warning' ELSE 'error' END AS severity, have AS observed, 'Contextual core parties present: ' || wanted || '.' AS expected,
  CASE WHEN blocking <> '' THEN 'One or more contextually expected core parties are missing.' WHEN context <> '' THEN 'One or more monitored core parties are missing, but nearby polls do not make this a blocking issue.' END AS message, CASE WHEN blocking <> '' THEN blocking ELSE context END AS affected
  FROM poll JOIN told ON poll_id = poll.id JOIN g7 ON g7.id = poll.id JOIN wanted ON wanted.id = poll.id)
SELECT 'qc_range' AS check_name, * FROM range_ UNION ALL SELECT 'qc_sum', * FROM sum_ UNION ALL SELECT 'qc_dates', * FROM dates UNION ALL SELECT 'qc_respondents', * FROM asked UNION ALL SELECT 'qc_core', * FROM core_
UNION ALL SELECT 'qc_jump_institute', * FROM is_ UNION ALL SELECT 'qc_jump_scope', * FROM ss""".replace("is AS (SELECT p.id", "is_ AS (SELECT p.id"))
def g11_check_details(spark, d):
    """What the seven checks of each poll observed, expected and say; observed values as JSON."""
    rows = flags(spark, d).select("poll_id", F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(f"checks.{c}").alias("c")) for c in V.CHECKS])).alias("x"))
    c = F.col("x.c")
    return rows.select("x.check_name", F.col("poll_id").alias("id"), c["passed"].alias("passed"), c["severity"].alias("severity"), F.to_json(c["observed"]).alias("observed"), c["expected"].alias("expected"), c["message"].alias("message"), F.array_join(c["affected_parties"], ",").alias("affected"))


@query(f"WITH {_FLAGS} SELECT count(*) AS total, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid, count(*) FILTER (warning_count > 0) AS with_warning FROM val")
def g12_run_summary(spark, d):
    return V.summary(validations(spark, d))


_REPORT = f"""{_FLAGS}, long AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS position, unnest([{', '.join("'" + c + "'" for c in V.CHECKS)}]) AS check_name, unnest([{', '.join(V.CHECKS)}]) AS ok FROM val),
report AS (SELECT position, check_name, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed FROM long GROUP BY 1, 2)"""


@query(f"WITH {_REPORT} SELECT *, round(passed / (passed + failed), 4) AS pass_share FROM report")
def g13_check_report(spark, d):
    return V.check_report(validations(spark, d))


@query(f"WITH {_REPORT} SELECT row_number() OVER (ORDER BY failed DESC, position) AS rank, check_name, failed FROM report WHERE failed > 0 ORDER BY rank LIMIT 3")
def g14_top_failing(spark, d):
    return V.top_failing(V.check_report(validations(spark, d)), 3)


QUALITY = f"""{_FLAGS}, s AS (SELECT count(*) AS total, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid, count(*) FILTER (warning_count > 0) AS with_warning FROM val),
shares AS (SELECT *, coalesce(round(valid / nullif(total, 0), 4), 0) AS valid_share, coalesce(round(invalid / nullif(total, 0), 4), 0) AS invalid_share, coalesce(round(with_warning / nullif(total, 0), 4), 0) AS with_warning_share FROM s),
quality AS (SELECT *, CASE WHEN total = 0 THEN 'warn' WHEN invalid_share > 0.05 THEN 'fail' WHEN valid_share < 0.9 OR with_warning_share > 0.1 THEN 'warn' ELSE 'pass' END AS status FROM shares)"""


@query(f"""WITH {QUALITY} SELECT *, (SELECT max(o_orderdate) FROM orders) AS latest_validated_at, CASE status WHEN 'pass' THEN 'ready' WHEN 'warn' THEN 'review_recommended' ELSE 'attention_needed' END AS public_status FROM quality""")
def g15_quality_status(spark, d):
    at = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("poll_id"), F.col("o_orderdate").alias("validated_at"))
    return V.quality_status(validations(spark, d).join(at, "poll_id"))


@query(f"WITH {_FLAGS} SELECT poll_id, valid FROM val WHERE NOT valid OR NOT qc_jump_institute OR NOT qc_jump_scope ORDER BY poll_id LIMIT 50")
def g16_flagged(spark, d):
    return V.flagged(validations(spark, d), 50)
