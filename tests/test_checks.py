"""Literal cases of the checks' structs, jump details, reports by year, latest polls."""

import json

from pyspark.sql import functions as F

from surveyloom.operators import validate as V, views as H

POLLS = "id long, publish_date date, survey_start date, survey_end date, respondents int, method string, scope string, institute string"


def frames(spark, polls, results):
    days = [(i, *(None if d is None else d for d in rest)) for i, *rest in polls]
    p = spark.createDataFrame(days, POLLS.replace(" date", " string")).withColumns({c: F.col(c).cast("date") for c in ("publish_date", "survey_start", "survey_end")})
    return p, spark.createDataFrame(results, "poll_id long, party string, percentage double")


def test_structs_of_the_seven_checks(spark):
    week = ("2024-01-05", "2024-01-08")
    polls, results = frames(
        spark,
        [(1, "2024-01-10", *week, 1000, "ONLINE", "federal", "INSA"), (2, "2024-01-11", *week, 10, None, "federal", ""), (3, None, None, None, None, "ONLINE", None, "INSA"), (4, "2024-01-12", *week, 1000, "ONLINE", "federal", "INSA")],
        [(1, "SPD", 60.0), (1, "CDU", 40.0), (2, "SPD", 20.0), (2, "CDU", 101.0), (4, "SPD", 65.0), (4, "CDU", 33.0)],
    )
    bounds = spark.createDataFrame([("ONLINE", 500, 5000), ("UNBEKANNT", 300, 10000)], "method string, low int, high int")
    rows = V.check_structs(polls, results, bounds, "UNBEKANNT", [("*", ["CDU", "FDP"], None, None)], F.lit("|x|"), ["CDU", "FDP"], F.lit("2024-06-30").cast("date"), V.CheckConfig(min_polls=1))
    got = {r["poll_id"]: json.loads(r["j"]) for r in rows.select("poll_id", F.to_json(F.struct(*V.CHECKS), {"ignoreNullFields": "false"}).alias("j")).collect()}
    assert got[1]["qc_range"] == {"passed": True, "severity": "error", "observed": {"CDU": 40.0, "SPD": 60.0}, "expected": "Each party percentage must be between 0 and 100.", "message": None, "affected_parties": []}
    assert got[2]["qc_range"]["affected_parties"] == ["CDU"] and not got[3]["qc_range"]["passed"] and got[3]["qc_range"]["observed"] == {}
    assert (got[1]["qc_sum"]["observed"], got[2]["qc_sum"]["observed"], got[4]["qc_sum"]["passed"]) == (100.0, 121.0, True)
    assert got[3]["qc_dates"]["message"] == "One or more required dates are missing." and got[1]["qc_dates"]["observed"]["publish_date"] == "2024-01-10"
    assert got[2]["qc_respondents"] == {"passed": False, "severity": "error", "observed": 10, "expected": "UNBEKANNT: respondents between 300 and 10000.", "message": "Respondent count is missing or outside plausible range.", "affected_parties": []}
    assert (got[1]["qc_core"]["passed"], got[1]["qc_core"]["severity"], got[1]["qc_core"]["affected_parties"]) == (True, "warning", ["FDP"])
    assert got[3]["qc_core"]["affected_parties"] == ["CDU", "FDP"] and got[3]["qc_core"]["observed"] == []
    jump = got[4]["qc_jump_institute"]
    assert jump["observed"] == [{"party_key": "CDU", "jump": -7.0, "current": 33.0, "previous": 40.0, "previous_poll_id": 1, "previous_public_id": "C00000001"}, {"party_key": "SPD", "jump": 5.0, "current": 65.0, "previous": 60.0, "previous_poll_id": 1, "previous_public_id": "C00000001"}]
    assert jump["message"] == "Large party result jump within same institute." and not jump["passed"] and jump["severity"] == "warning"
    assert got[2]["qc_jump_institute"] == {"passed": True, "severity": "warning", "observed": None, "expected": "Previous poll with same institute.", "message": "No institute value available for jump check.", "affected_parties": []}
    assert [j["previous_poll_id"] for j in got[4]["qc_jump_scope"]["observed"]] == [2, 2] and not got[2]["qc_jump_scope"]["passed"]
    report = V.validation_rows(V.flags_of(rows)).filter("poll_id = 4").first()
    assert (report["valid"], report["error_count"], report["warning_count"]) == (True, 0, 2) and json.loads(report["details"])["qc_sum"]["observed"] == 98.0


def test_jump_needs_a_group(spark):
    polls, results = frames(spark, [(i, f"2024-01-0{i}", None, None, 1, "x", s, s) for i, s in ((1, ""), (2, ""), (3, None), (4, None), (5, "by"), (6, "by"))], [(i, "SPD", 10.0 * i) for i in range(1, 7)])
    assert {r["id"]: r["passed"] for r in V.jump_check(polls, results, "institute").collect()} == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False}


def test_year_report(spark):
    polls = spark.createDataFrame([(1, "2024-01-01", "a", "s"), (2, "2024-05-01", "b", "s"), (3, "2024-06-01", None, "t"), (4, "2023-01-01", "a", "t"), (5, None, "a", "s")], "id long, d string, provider string, source string").withColumn("publish_date", F.col("d").cast("date"))
    seen = spark.createDataFrame([(1,), (4,), (5,)], "poll_id long")
    got = lambda *config: sorted(tuple(r) for r in H.year_report(polls, seen, *config).collect())
    assert got({}) == [(2023, "not configured", "not configured", 1, 1, 1), (2024, "not configured", "not configured", 3, 1, 3)]
    assert got({2024: {"provider": "b"}, 2023: {"source": "s"}}, {"provider": "a", "source": "s"}) == [(2023, "a", "s", 1, 1, 0), (2024, "b", "s", 3, 1, 1)]


def test_latest_and_sorted(spark):
    polls = spark.createDataFrame([(1, None), (2, "2024-01-01"), (3, "2024-01-02")], "id long, d string").withColumn("publish_date", F.col("d").cast("date"))
    assert [r["id"] for r in H.latest(polls, 5).collect()] == [3, 2, 1]
    rows = polls.crossJoin(spark.createDataFrame([("b",), ("a",)], "party string"))
    assert [(r["id"], r["party"]) for r in H.sort_polls(rows).collect()] == [(3, "a"), (3, "b"), (2, "a"), (2, "b"), (1, "a"), (1, "b")]


def test_laid_out_tables_are_joined_without_a_shuffle(spark):
    from surveyloom.sources.layout import laid_out

    polls = spark.range(500).select("id", (F.col("id") % 3 + 2020).cast("int").alias("part"), (F.col("id") * 2).alias("raw_id"))
    results = spark.range(1500).select((F.col("id") % 500).alias("poll_id"), F.lit("SPD").alias("party"), (F.col("id") % 500 % 3 + 2020).cast("int").alias("part"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        p, r = laid_out(spark, polls, results, 4)
        rows = H.observations(p.filter("part = 2021").drop("part"), r.filter("part = 2021").drop("part"))
        assert "Exchange" not in plan(rows) and "PartitionFilters" in plan(rows) and rows.count() == 501
        found = H.lookup(p, "C00000077")
        assert "Exchange" not in plan(found) and [r["raw_id"] for r in found.collect()] == [154]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
