"""Small cases with known results."""

import datetime

import pytest
from pyspark.sql import Row, functions as F

from surveyloom.functions import survey as S
from surveyloom.operators import dedupe, match as M, select as P, validate as V, views as H
from surveyloom.sources import imports as I, span_tables as T
from surveyloom.streaming.ingest import ingest_new

D = datetime.date


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} {'date' if isinstance(v, D) else 'string'}" for k, v in cols.items())
    return spark.createDataFrame([tuple(cols.values())], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("2024-01-15", D(2024, 1, 15)), ("2024-01-15T10:00:00Z", D(2024, 1, 15)), ("15.01.2024", D(2024, 1, 15)), ("15. Januar 2024", D(2024, 1, 15)), ("15.01.24", D(2024, 1, 15)), ("31.02.2024", None), ("", None), ("x", None)])
def test_publish_date(spark, text, want):
    assert one(spark, S.publish_date(F.col("c")), c=text) == want


def test_public_id(spark):
    ids = [7, 12345678, 123456780, 123456789, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select("id", S.public_id("C", F.col("id")).alias("x")).collect()
    assert {r["id"]: r["x"] for r in rows} == {7: "C00000007", 12345678: "C12345678", 123456780: "C123456780", 123456789: "C123456789", None: None}
    polls = spark.createDataFrame([(12345678,), (123456789,)], "id long").withColumn("raw_id", F.col("id"))
    assert [r["id"] for r in H.lookup(polls, "C123456789").collect()] == [123456789]


@pytest.mark.parametrize(("text", "pub", "want"), [("09.12.–13.12.", D(2024, 1, 1), (D(2023, 12, 9), D(2023, 12, 13))), ("30.12.–03.01.", D(2024, 1, 4), (D(2023, 12, 30), D(2024, 1, 3))), ("30.06.", D(2024, 7, 2), (D(2024, 6, 30), None)), ("bis 31.08.", D(2024, 9, 1), (None, None)), ("01.03.2024-05.03.2024", D(2024, 3, 9), (D(2024, 3, 1), D(2024, 3, 5)))])
def test_survey_window(spark, text, pub, want):
    none = F.lit(None).cast("string")
    w = one(spark, S.survey_window(none, none, F.col("c"), F.col("p")), c=text, p=pub)
    assert (w["start"], w["end"]) == want


@pytest.mark.parametrize(("text", "count", "method"), [("O • 2.004", 2004, "ONLINE"), ("TOM • 1.202", 1202, "TELEFON_ONLINE"), ("telefonisch 1000", 1000, "TELEFONISCH"), ("TOM • 1.00325.02.–03.03.", 1003, "TELEFON_ONLINE"), ("", None, None)])
def test_respondents(spark, text, count, method):
    assert one(spark, S.respondents(F.col("c")), c=text) == count
    assert one(spark, S.method_hint(F.col("c")), c=text) == method


@pytest.mark.parametrize(("text", "want"), [("16,5 %", 16.5), ("5–7", 6.0), ("–", None), ("12 %", 12.0), ("BSW 2 %BP 1 %Sonst. 5 %", 8.0)])
def test_percentage(spark, text, want):
    assert one(spark, S.percentage(F.col("c")), c=text) == want


POLL = "id long, publish_date date, provider string, institute int, scope int, election string, respondents int, survey_start date, survey_end date"


def linked(spark, primary, secondary, results, own="E", other="E", **cfg):
    cfg = M.MatchConfig(**cfg)
    polls = spark.createDataFrame([(i, d, "p", 1, None, own, r, s, e) for i, d, r, s, e in primary] + [(i, d, "s", 1, None, other, r, s, e) for i, d, r, s, e in secondary], POLL)
    res = spark.createDataFrame([(i, p, float(v)) for i, pair in results.items() for p, v in zip(("SPD", "AFD"), pair)], "poll_id long, party string, percentage double")
    a, b = M.side(polls, res, "P", cfg), M.side(polls, res, "s", cfg)
    return {r["id"]: (r["status"], r["matched_id"]) for r in M.link(a, b, M.choose(M.with_evidence(M.candidates(a, b, cfg), cfg), cfg)).collect()}


def test_matching(spark):
    d = lambda x: D(2024, 6, x)
    assert linked(spark, [(1, d(1), None, None, None)], [(2, d(3), None, None, None)], {1: (16, 17), 2: (16, 17.5)}) == {1: ("matched", 2), 2: ("matched", 1)}
    same = {1: (16, 17), 2: (16, 17), 3: (16, 17)}
    for own, other, status in (("E", "E", "matched"), ("E", "F", "no_match"), ("E", None, "matched"), ("", "F", "matched"), (None, None, "matched")):
        got = linked(spark, [(1, d(1), None, None, None)], [(2, d(2), None, None, None)], same, own, other)
        assert {s for s, _ in got.values()} == {status}, (own, other)
    assert {s for s, _ in linked(spark, [(1, d(10), None, None, None)], [(2, d(11), None, None, None), (3, d(9), None, None, None)], same).values()} == {"multiple_matches"}
    assert {s for s, _ in linked(spark, [(1, d(1), None, None, None)], [(2, d(2), None, None, None)], {1: (16, 17), 2: (16, 18)}, max_party_delta=0.4, max_total_delta=0.4).values()} == {"no_match"}
    got = linked(spark, [(1, d(30), None, d(23), d(29))], [(2, d(30), None, d(23), d(29)), (3, d(30), None, d(20), d(25))], same)
    assert got[1] == ("matched", 2) and got[3] == ("no_match", None)
    got = linked(spark, [(1, d(30), 2505, None, None)], [(2, d(30), 1200, None, None), (3, d(29), 2505, None, None)], same)
    assert got[1] == ("matched", 3)


def test_selection(spark):
    rows = [(1, D(2004, 12, 31), "historic", None), (2, D(2004, 12, 31), "primary", None), (3, D(2005, 1, 1), "primary", None), (4, D(2005, 1, 1), "secondary", "no_match"), (5, D(2005, 1, 1), "secondary", "matched"), (6, None, "primary", None), (7, D(2005, 1, 1), " ", None)]
    got = P.select_public(spark.createDataFrame(rows, "id long, publish_date date, provider string, status string"), P.SelectionConfig())
    assert {r["id"]: r["reason"] for r in got.collect()} == {1: None, 2: "non_primary_provider_before_cutoff", 3: None, 4: None, 5: "matched_secondary_provider", 6: "missing_publish_date", 7: "missing_provider"}


def test_checks_and_guards(spark):
    polls = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "a", D(2024, 1, 2)), (3, None, D(2024, 1, 3))], "id long, g string, publish_date date")
    res = spark.createDataFrame([(1, "x", 10.0), (2, "x", 14.0), (3, "x", 90.0)], "poll_id long, party string, percentage double")
    assert {r["id"]: r["passed"] for r in V.jump_check(polls, res, "g", 4.0).collect()} == {1: True, 2: True, 3: True}
    assert {r["id"]: r["passed"] for r in V.jump_check(polls, res, "g", 3.9).collect()} == {1: True, 2: False, 3: True}
    with pytest.raises(ValueError):
        V.research_ready(["nope"])
    with pytest.raises(ValueError):
        H.filter_polls(polls, date_from="2024-02-01", date_to="2024-01-01")
    with pytest.raises(ValueError):
        H.lookup(polls, "X1")


def test_html(spark):
    html = "<table class='wilko'><tr><th></th><th>Institut</th><th>SPD</th></tr><tr><td>1.1.2024</td><td>A</td><td>20&nbsp;%</td></tr><tr><td>x</td></tr><tr><td>2.1.</td><td>B</td><td></td></tr></table>"
    headed = "<table class='a wilko'><thead><tr><th>Datum</th><th>SPD</th><th>SPD</th></tr></thead><tbody><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></tbody></table>"
    rows = T.plain_tables(spark.createDataFrame([(1, html), (2, None), (3, "<p>"), (4, headed), (5, "<table class='wilko'>")], "page_id long, html string")).orderBy("page_id").collect()
    assert [(r["fields"]["Datum"], r["parties"]) for r in rows] == [("1.1.2024", {"SPD": "20 %"}), ("1", {"SPD": "3"})]


@pytest.mark.parametrize(("text", "year", "start", "end", "kind"), [
    ("24.06.-26.06.2024", None, D(2024, 6, 24), D(2024, 6, 26), "VALID_RANGE"), ("01.–05.03.2024", None, D(2024, 3, 1), D(2024, 3, 5), "VALID_RANGE"), ("1-5.3.2024", None, D(2024, 3, 1), D(2024, 3, 5), "VALID_RANGE"),
    ("01.03.2024 - 05.03.2024", None, D(2024, 3, 1), D(2024, 3, 5), "VALID_RANGE"), ("01.03.2024-05.03.2024", None, D(2024, 3, 1), D(2024, 3, 5), "VALID_RANGE"), ("28.10.–01.11.", 2024, D(2024, 10, 28), D(2024, 11, 1), "VALID_RANGE"),
    ("28.10.–01.11.", None, None, None, "INVALID"), ("28.10. – 01.11.2024", None, None, None, "INVALID"), ("31.02.–05.03.2024", None, D(2024, 3, 2), D(2024, 3, 5), "VALID_RANGE"), ("31.02.–31.02.", 2024, None, None, "INVALID"),
    ("20:15-22:00 Uhr", 2024, None, None, "TIME_RANGE"), ("??.09.–??.09.", 2024, None, None, "UNKNOWN_DATE"), ("Bundestagswahl", 2024, None, None, "ELECTION_MARKER"), ("bis 31.08.", 2024, None, None, "BIS_PREFIX"),
    ("bis 31.08.", None, None, None, "INVALID"), ("30.6", 2024, D(2024, 6, 30), None, "SINGLE_DATE"), ("1.234", 2024, None, None, "INVALID"), ("", 2024, None, None, "INVALID"), ("Online-Umfrage 01.–05.03.2024", None, D(2024, 3, 1), D(2024, 3, 5), "VALID_RANGE"),
])
def test_timeframe(spark, text, year, start, end, kind):
    w = one(spark, S.timeframe(F.col("c"), F.lit(year) if year else None), c=text)
    assert (w["start"], w["end"], w["type"], w["ignore"]) == (start, end, kind, kind in ("TIME_RANGE", "UNKNOWN_DATE", "ELECTION_MARKER"))


def test_state_names(spark):
    for text, key in (("BY  | (Bayern)", "BY"), ("nrw", "NW"), ("NW | (Nordrhein-Westfalen)", "NW"), ("Ost", "OST"), ("x", "BUND"), ("", "BUND")):
        assert one(spark, S.state(F.col("c")), c=text) == key


def test_fingerprints_apart(spark):
    """Signs that separate fields, and nulls, make no two polls one; polls without results have no fingerprint and no duplicates."""
    rows = [(1, "a|b", "c", "x"), (2, "a", "b|c", "x"), (3, None, "c", "x"), (4, "~", "c", "x"), (5, "a|b", "c", "x"), (6, "a", "c", None), (7, "a", "c", None)]
    frame = spark.createDataFrame(rows, "id long, p string, q string, party string")
    results = F.when(F.col("party").isNotNull(), F.array(F.struct("party", F.lit(1.5).alias("percentage"))))
    made = frame.withColumn("fingerprint", dedupe.fingerprint({"p": F.col("p"), "q": F.col("q")}, results))
    of = {r["id"]: r["fingerprint"] for r in made.collect()}
    assert of[1] == of[5] and len({of[i] for i in (1, 2, 3, 4)}) == 4 and of[6] is None
    kept, dups = dedupe.first_by_fingerprint(made.select("id", "fingerprint"), made.select("id", "fingerprint").limit(0))
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7] and [tuple(r) for r in dups.collect()] == [(5, 1)]


def test_counts_of_no_source(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, source string")
    assert {tuple(r) for r in dedupe.ingest_counts(rows, rows.filter("id <> 2"), "source").collect()} == {(None, 2, 1, 1), ("a", 1, 1, 0)}


def test_dumps(spark):
    dump = '{"Parties": {"1": {"Shortcut": "SPD"}, "2": {"Shortcut": "SPD"}}, "Surveys": {"7": {"Institute_ID": "3", "Results": {"1": "16", "2": 17, "9": "x", "8": 5}}}}'
    frame = spark.createDataFrame([(dump,)], "d string")
    r = I.flatten_dump(frame, "d").first()
    assert (r["survey_id"], r["Institute"], r["parties"], r["survey_date_start"]) == ("7", None, {"SPD": 17.0, "8": 5.0}, None)
    empty = spark.createDataFrame([('{"Surveys": {}}',), ("x",)], "d string")
    assert I.flatten_dump(empty, "d", on_empty="skip").count() == 0
    with pytest.raises(Exception, match="no surveys"):
        I.flatten_dump(empty, "d").collect()


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffDatum,Institut ,CDU/CSU,SPD,results\n2024-01-01,"A, B",30,,\n2024-01-02,C,,,"{""FDP"": ""7""}"\n2024-01-03,D,,,\n', encoding="utf-8")
    rows = I.csv_import(I.read_csv(spark, str(tmp_path / "a.csv"))).orderBy("publish_date").collect()
    assert [(r["publish_date"], r["institute_id"], r["worker"], r["parties"], r["parties_error"] is None) for r in rows] == [
        ("2024-01-01", "A, B", "import:csv", {"CDU/CSU": "30"}, True), ("2024-01-02", "C", "import:csv", {"FDP": "7"}, True), ("2024-01-03", "D", "import:csv", None, False),
    ]


def test_long_values(spark):
    for text, want in (("13,5", "13.5"), ("12,0", "12"), ("0.1234567", "0.123457"), ("k.A.", None), (" 7 ", "7"), ("-0,50", "-0.5")):
        assert one(spark, I.number_text(F.col("c")), c=text) == want
    for text, want in (("Emnid Archived 2001", "Verian (Emnid)"), ("X (MRP)", "X"), ("", "Unknown"), ("X (MRP) y", "X (MRP) y")):
        assert one(spark, I.institute_text(F.col("c")), c=text) == want


def test_catalogue(spark):
    rows = I.catalogue(spark.createDataFrame([("a", "AScraper", "Stimmung"), ("b", "BTotal", " ")], "worker string, class_name string, Survey_Type string")).collect()
    assert [(r["worker"], r["survey_type"], r["active"]) for r in rows] == [("a", "Stimmung", True), ("b", "Projektion", False)]


def test_gate(spark):
    polls = spark.createDataFrame([(1, "p", D(2024, 1, 1), True), (2, "p", D(2024, 1, 1), True), (3, "p", D(2024, 1, 1), True), (4, "Historic", D(2004, 1, 1), True), (5, "p", D(2024, 1, 1), False)], "id long, provider string, publish_date date, is_public boolean")
    checks = spark.createDataFrame([(1, True, 0, True), (2, True, 1, False), (3, False, 2, False), (5, True, 0, True)], "poll_id long, valid boolean, warning_count int, qc boolean")
    shown = lambda **policy: [r["id"] for r in P.serving_gate(polls, checks, P.GatePolicy(**policy)).orderBy("id").collect()]
    assert shown() == [1, 2, 4] and shown(include_warnings=False) == [1, 4] and shown(include_valid=False) == [3] and shown(required_checks=("qc",)) == [1, 4]
    more = polls.unionByName(spark.createDataFrame([(6, "p", D(2024, 1, 1), True)], polls.schema))
    assert [r["id"] for r in P.serving_gate(more, checks, P.GatePolicy(require_validation=False)).orderBy("id").collect()] == [1, 2, 4, 6]


def test_presence_and_jumps_across_years(spark):
    """Undated polls compare with their whole scope; a jump over a year's end, and one after an undated poll, are found."""
    polls = spark.createDataFrame([(1, "a", None), (2, "a", D(2023, 12, 30)), (3, "a", D(2024, 1, 2)), (4, "a", D(2030, 1, 2)), (5, None, D(2024, 1, 1))], "id long, scope string, publish_date date")
    res = spark.createDataFrame([(1, "x", 10.0), (2, "x", 20.0), (3, "x", 21.0), (4, "x", 30.0), (5, "y", 1.0)], "poll_id long, party string, percentage double")
    assert {r["id"]: (r["passed"], r["largest"]) for r in V.jump_check(polls, res, "scope", 4.0).collect()} == {1: (True, None), 2: (False, 10.0), 3: (True, None), 4: (False, 9.0), 5: (True, None)}
    got = {(r["id"], r["party"]): (r["has"], r["comparisons"], r["with_party"]) for r in V.presence(polls, res, ["x", "y"]).collect()}
    assert got[1, "x"] == (1, 3, 3) and got[2, "x"] == (1, 1, 1) and got[4, "x"] == (1, 0, 0) and got[5, "y"] == (1, 0, 0) and got[2, "y"] == (0, 1, 0)


def test_names_that_are_none(spark):
    polls = spark.createDataFrame([(1, "federal")], "id long, scope string")
    with pytest.raises(ValueError):
        H.dataset("other", polls, polls, P.GatePolicy())
    assert H.filter_polls(polls, scopes=["Deutschland"], institutes=[]).count() == 1
    assert H.filter_polls(polls.withColumn("method", F.lit("X")), methods=[" "]).count() == 0
    quality = V.quality_status(spark.createDataFrame([], "valid boolean, warning_count long"))
    assert quality.select("total", "valid_share", "status", "public_status").first()[:] == (0, 0.0, "warn", "review_recommended")
    runs = spark.createDataFrame([], "ended timestamp")
    assert H.freshness(polls, runs, quality, F.lit("2030-01-01").cast("timestamp")).first()["status"] == "warn"


def test_export_and_stream(spark, tmp_path):
    df = spark.createDataFrame([Row(id=1, parts=[Row(a=1)])])
    I.export(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/parquet")).first()["parts"] == '[{"a":1}]'
    assert spark.read.json(str(tmp_path / "out/json")).first()["parts"][0]["a"] == 1
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "seq long, k string")
    rows.coalesce(1).write.json(str(tmp_path / "in"))
    args = (spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "seq")
    ingest_new(*args)
    ingest_new(*args)
    spark.createDataFrame([(4, "b"), (5, "c")], "seq long, k string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    ingest_new(*args)
    assert sorted(r["seq"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3, 5]


def test_span_tables(spark):
    heads = "".join(f"<th>{h}</th>" for h in ["Datum", "", "Institut", "Auftraggeber", "Befragte", "", "CDU", "CSU", "SPD"])
    row = "<tr><td>01.06.2024</td><td></td><td>A&nbsp;B</td><td></td><td>1.000</td><td></td><td colspan=2>30</td><td>16</td></tr>"
    one = f"<table class='wilko x'><thead><tr>{heads}</tr></thead><tbody>{row}<tr><td>01.06.24</td></tr>{row.replace('30', '').replace('16', ' ')}</tbody></table>"
    group = "<tr><th class='li' id='bw'>BW</th><td></td><td>A (01.06.24)</td><td>Z</td><td title='Online'>Online 500<br>??.05.</td><td></td><td>20</td><td></td><td>9</td><td>8</td></tr>"
    below = "<tr><td>B (02.06.2024)</td><td></td><td title='T'>600</td><td></td><td colspan='x'>21</td></tr><tr></tr><tr><td>C</td><td></td><td></td><td></td><td>1</td></tr>"
    pages = spark.createDataFrame([(1, one + one + f"<table class='wilko'><thead><tr>{heads}</tr></thead><tbody>{below}{group}{below}</tbody></table>"), (2, None), (3, ""), (4, "<table class='wilko'>")], "page_id long, html string")
    spanned = T.spanned_tables(pages).orderBy("tab").collect()
    assert [(r["tab"], r["institute"], r["client"], [tuple(x) for x in r["results"]]) for r in spanned] == [(t, "A B", None, [("CDU/CSU", "30"), ("SPD", "16")]) for t in (0, 1)]
    grouped = T.grouped_tables(pages).orderBy("row").collect()
    assert [(r["state"], r["institute"], r["date"], r["respondents"], r["timeframe"], [tuple(x) for x in r["results"]]) for r in grouped] == [
        ("BUND", "B", "02.06.2024", "600 T", "", [("CDU", "21")]),
        ("BW", "A", "01.06.24", "Online 500", "??.05.", [("CDU", "20"), ("SPD", "9")]),
        ("BW", "B", "02.06.2024", "600 T", "", [("CDU", "21")]),
    ]
    assert T.spanned_tables(pages.limit(0)).count() == T.grouped_tables(pages.filter("page_id > 1")).count() == 0


def test_run_modes(spark, tmp_path):
    raw, polls = spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame([(1,)], "raw_id long")
    ids = lambda mode, limit=None: [[r[0] for r in x.collect()] for x in dedupe.select_run(raw, polls, raw.filter("id = 2"), mode, limit)]
    assert (ids("incremental"), ids("reprocess", 2), ids("rebuild", 0)) == ([[3], [1]], [[1, 2], [1]], [[1, 2, 3], []])
    with pytest.raises(ValueError):
        dedupe.select_run(raw, polls, raw, "other")
    version = str(tmp_path / "v1")
    assert dedupe.finish_run(raw, version, dry_run=True) == 3 and not (tmp_path / "v1").exists()
    assert dedupe.finish_run(raw, version) == 3 == spark.read.parquet(version).count()


def test_source_catalogue(spark):
    catalogue = spark.createDataFrame([("a", "BB", "L", "X", "P", "T", True), ("b", "BUND", "B", "Y", "P", "T", False)], "worker string, state string, scope string, institute string, provider string, survey_type string, own_institute boolean")
    rows = spark.createDataFrame([(1, "a", "Own", "old"), (2, "a", None, "old"), (3, "b", "Own", "old"), (4, None, "Own", "old")], "id int, worker string, institute string, state string")
    got = {r["id"]: (r["institute"], r["state"]) for r in I.enrich_by_worker(rows, catalogue).collect()}
    assert got == {1: ("Own", "BB"), 2: ("X", "BB"), 3: ("Y", "BUND"), 4: (None, None)}
