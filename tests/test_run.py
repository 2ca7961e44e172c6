"""One cleaning run over versions of the tables, against a run row by row; versions; relinking near changes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import clean as C, match as M, run as R
from surveyloom.operators.dedupe import key_digest, reject_known, select_run
from surveyloom.operators.joins import dense_numbers, join_groups
from surveyloom.sources.versions import Change, Versions
from surveyloom.streaming.ingest import clean_batch, ingest_and_clean


def test_dense_numbers(spark):
    rows = spark.createDataFrame([(i * 7 % 1000, f"x{i}") for i in range(1000)], "k long, v string").repartition(6)
    got = dense_numbers(rows, ["k"]).orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, 1001)) and [r["k"] for r in got] == list(range(1000))
    assert dense_numbers(rows.limit(0), ["k"]).count() == 0


def test_join_groups_keeps_all_rows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).filter("k % 2 = 0")
    got = join_groups(rows, groups, ["k"], "n", 5000)
    assert got.count() == 5000 and got.filter("k = 0 and n = 3000").count() == 3000 and got.filter("n is null").count() == 1000


def test_known_rows_by_digest(spark):
    """Nulls are equal; a digest that all rows share changes nothing; a stored digest is used."""
    schema = "a string, b int"
    known = spark.createDataFrame([("x", 1), (None, 2), ("y", None)], schema)
    new = spark.createDataFrame([("x", 1), ("x", 2), (None, 2), ("y", None), (None, None), ("x", 2)], schema)
    want = [(None, None), ("x", 2), ("x", 2)]
    key = lambda rows: sorted([tuple(r) for r in rows.collect()], key=repr)
    assert key(reject_known(new, known, ["a", "b"])) == sorted(want, key=repr)
    assert key(reject_known(new, known, ["a", "b"], made=lambda keys: F.lit("same"))) == sorted(want, key=repr)
    stored = known.withColumn("d", key_digest(["a", "b"]))
    assert key(reject_known(new, stored, ["a", "b"], "d")) == sorted(want, key=repr)
    assert key(reject_known(new, known.limit(0), ["a", "b"])) == key(new)


def owners_brute(rows, polls):
    owner, of = {p["fingerprint"]: p["raw_id"] for p in polls if p["fingerprint"]}, {p["raw_id"]: p["fingerprint"] for p in polls}
    out = {}
    for i, f in sorted(rows):
        if i in of:
            old = of[i]
            if old is not None and old != f:
                del owner[old]
            free = owner.get(f, i) == i
            of[i] = f if free else None
            if free:
                owner[f] = i
            out[i] = (True, of[i], None)
        elif f in owner:
            out[i] = (False, None, owner[f])
        else:
            owner[f], of[i] = i, f
            out[i] = (False, f, None)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_owners_as_one_by_one(spark, seed):
    rnd = random.Random(seed)
    prints = [f"f{i}" for i in range(rnd.choice([4, 12, 40]))]
    stored = rnd.sample(range(60), 25)
    polls = [{"id": 1000 + i, "raw_id": r, "fingerprint": f} for i, (r, f) in enumerate(zip(stored, rnd.sample(prints * 9, 25), strict=True))]
    seen = set()
    for p in polls:  # no two polls of one fingerprint
        p["fingerprint"] = None if p["fingerprint"] in seen else p["fingerprint"]
        seen.add(p["fingerprint"])
    rows = [(i, rnd.choice(prints)) for i in rnd.sample(range(80), 55)] + [(i, prints[0]) for i in range(100, 3000)] * (seed == 3)
    got = R.owners(spark.createDataFrame(rows, "id long, fingerprint string"), spark.createDataFrame(polls, "id long, raw_id long, fingerprint string"))
    assert {r["id"]: (r["existed"], r["fingerprint"], r["duplicate_of_raw"]) for r in got.collect()} == owners_brute(rows, polls)


def raw_row(i, **given):
    row = {
        "id": i, "publish_date": "2024-01-10", "survey_date_start": "2024-01-05", "survey_date_end": "2024-01-08", "respondents": "1000", "zeitraum": None, "parties": json.dumps({"CDU/CSU": "27", "SPD": "18", "AfD": "16"}),
        "institute_id": "INSA", "provider": "primary", "source": "html_scraper", "scope": "Bund", "election_id": "Bundestagswahl", "method_id": "Online", "date_downloaded": "2024-01-11T10:00:00",
    }
    return row | given


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in R.RAW.split(", ")) for r in rows], R.RAW)


def tables_of(tables, version=None):
    rows = lambda name, schema: sorted([tuple(r) for r in tables.read(name, schema, version).collect()], key=repr)
    return {name: rows(name, schema) for name, schema in (("polls", R.POLLS), ("results", R.RESULTS), ("duplicates", R.DUPLICATES))}


def runs(spark, tmp_path, name, *steps):
    tables, counters = Versions(spark, f"file://{tmp_path}/{name}"), []
    for rows, mode in steps:
        counters.append(R.commit_run(tables, R.clean_run(spark, tables, frame(spark, rows), mode))[1])
    return tables, counters


def mixed(n, seed=5):
    """Raw rows of two providers over two years, with repeats, rows to reject and rows that match."""
    rnd, out = random.Random(seed), []
    for i in range(1, n + 1):
        day = rnd.choice(["2023-12-28", "2024-01-02", "2024-01-05", "2024-03-01"])
        share = str(rnd.choice([16, 17, 18, 30]))
        out.append(raw_row(
            i, publish_date=rnd.choice([day, day, day, "?"]), survey_date_start=None, survey_date_end=None, respondents=rnd.choice(["1.000", "O • 1.204", ""]), zeitraum=rnd.choice([None, "Bundestagswahl", "28.12.–30.12.", None]),
            parties=rnd.choice([json.dumps({"CDU/CSU": "27", "SPD": share, "AfD": share}), json.dumps({"Summe": "100"}), "no json", json.dumps({"SPD": "20", "Neue": "3"})]),
            institute_id=rnd.choice(["INSA", "Forsa"]), provider=rnd.choice(["primary", "secondary", None]),
        ))
    return out


def test_run_of_one_row(spark, tmp_path):
    one = raw_row(1, publish_date="2024-06-01", survey_date_start=None, survey_date_end=None, respondents="O • 1.00024.05.–28.05.", parties=json.dumps({"CDU/CSU": "30,5", "SPD": "16", "Summe": "100"}), institute_id="Forsa", method_id="99")
    tables, counters = runs(spark, tmp_path, "one", ([one, raw_row(2, publish_date="2024-06-01", respondents="O • 1.000", zeitraum="24.05.–28.05.", survey_date_start=None, survey_date_end=None, scope="BW", election_id="Europawahl")], "incremental"))
    p, q = tables.read("polls", R.POLLS).orderBy("id").collect()
    assert (str(p["survey_start"]), str(p["survey_end"]), p["institute"], p["method"], p["election"], p["scope"], p["respondents"]) == ("2024-05-24", "2024-05-28", "FORSA", "ONLINE", "BUND", "federal", 1000)
    assert (q["election"], q["scope"], str(q["survey_start"])) == ("EU_WAHLEN", "bw", "2024-05-24")
    assert {(r["poll_id"], r["party"], r["percentage"]) for r in tables.read("results", R.RESULTS).collect()} == {(1, "CDU_CSU", 30.5), (1, "SPD", 16.0), (2, "CDU_CSU", 27.0), (2, "SPD", 18.0), (2, "AFD", 16.0)}
    assert counters[0]["created"] == 2 and counters[0]["public"] == 2


def test_rows_are_read_once_and_rejected_ones_no_further(spark):
    """A payload is parsed in one place of the plan, raw rows are sorted for a limit only, and what comes after a row's rejection is null."""
    good, undated, ignored, empty = raw_row(1), raw_row(2, publish_date="?"), raw_row(3, survey_date_start=None, survey_date_end=None, zeitraum="??.09.–??.09."), raw_row(4, parties="no json")
    raw = frame(spark, [good, undated, ignored, empty])
    cleaned = R.clean_rows(raw)
    assert cleaned._jdf.queryExecution().analyzed().toString().count("from_json") == 1
    rows = {r["id"]: r for r in cleaned.collect()}
    assert {i: r["reason"] for i, r in rows.items()} == {1: None, 2: "missing publish date", 3: "ignored timeframe", 4: "no party result"}
    assert rows[1]["fingerprint"] and rows[1]["institute"] == "INSA" and all(rows[i][c] is None for i in (2, 3, 4) for c in ("institute", "scope", "method", "respondents", "fingerprint"))
    none = spark.createDataFrame([], "id long, raw_id long")
    for mode in ("incremental", "reprocess", "rebuild"):
        sorts = lambda limit: "Sort [" in select_run(raw, none, none, mode, limit)[0]._jdf.queryExecution().analyzed().toString()  # noqa: E731, B023
        assert (sorts(None), sorts(2)) == (False, True)


def test_fallback_dates_are_looked_for_once(spark):
    """The respondents text is searched in one place of the plan, and fills what is missing only."""
    day = "2024-06-01"
    rows = spark.createDataFrame([(1, day, day, None, "O • 1.00024.05.–28.05.", "99", " "), (2, day, day, day, "1000 24.05.–28.05.", "99", "x"), (3, day, None, None, None, None, None)], "id int, p string, s string, e string, respondents_text string, method_text string, provider string")
    date = lambda c: F.col(c).cast("date")
    got = C.with_fallbacks(rows.select("id", date("p").alias("publish_date"), date("s").alias("survey_start"), date("e").alias("survey_end"), "respondents_text", "method_text", "provider"))
    assert got._jdf.queryExecution().analyzed().toString().count("slice(") == 1
    want = [("2024-06-01", "2024-05-28", "ONLINE", "Unknown"), ("2024-06-01", "2024-06-01", "UNBEKANNT", "x"), ("None", "None", "UNBEKANNT", "Unknown")]
    assert [(str(r["survey_start"]), str(r["survey_end"]), r["method"], r["provider"]) for r in got.orderBy("id").collect()] == want


def test_duplicates_and_backfill(spark, tmp_path):
    tables, counters = runs(spark, tmp_path, "dup", ([raw_row(1), raw_row(2), raw_row(3, provider="other")], "incremental"))
    assert counters[0] == {"processed": 3, "created": 2, "updated": 0, "skipped": 1, "matched": 0, "ambiguous": 0, "public": 1, "excluded": 1}
    assert [tuple(r)[:2] for r in tables.read("duplicates", R.DUPLICATES).collect()] == [(2, 1)]
    blanked = tables.read("polls", R.POLLS).withColumn("fingerprint", F.when(F.col("id") > 1, F.col("fingerprint")))
    tables.commit({"polls": Change(blanked)})
    run = R.clean_run(spark, tables, frame(spark, [raw_row(1), raw_row(2), raw_row(3, provider="other"), raw_row(4)]))
    assert R.dry_run(run)["skipped"] == 1 and tables.latest() == 2
    assert R.commit_run(tables, run)[1]["created"] == 0
    assert tables.read("polls", R.POLLS).filter("fingerprint is null").count() == 0
    assert sorted(tuple(r)[:2] for r in tables.read("duplicates", R.DUPLICATES).collect()) == [(2, 1), (4, 1)]


def test_all_modes_end_in_the_same_tables(spark, tmp_path):
    rows = mixed(120)
    once, counters = runs(spark, tmp_path, "once", (rows, "incremental"))
    want, polls, c = tables_of(once), once.read("polls", R.POLLS), counters[0]
    assert (c["processed"], c["created"], c["public"], c["excluded"]) == (120, polls.count(), polls.filter("is_public").count(), polls.filter("not is_public").count())
    assert c["matched"] == polls.filter("provider = 'primary' and matching_status = 'matched'").count() > 0
    assert want["duplicates"] and {p[-4] for p in want["polls"]} >= {"matched", "no_match"}
    twice, _ = runs(spark, tmp_path, "twice", (rows[:70], "incremental"), (rows, "incremental"))
    assert tables_of(twice) == want
    again = R.commit_run(once, R.clean_run(spark, once, frame(spark, rows), "reprocess"))[1]
    assert tables_of(once) == want and again["updated"] == counters[0]["created"] and again["created"] == 0
    R.commit_run(once, R.clean_run(spark, once, frame(spark, rows), "rebuild"))
    assert tables_of(once) == want == tables_of(once, 1)  # the old version can still be read
    assert R.commit_run(once, R.clean_run(spark, once, frame(spark, []), "incremental"))[1]["processed"] == 0


def test_changed_rules_move_fingerprints(spark, tmp_path):
    """Reprocessing with other values: every poll stays in place, a new row takes a fingerprint that an update gave up, only touched years are rewritten."""
    first = [raw_row(1), raw_row(2, respondents="2000"), raw_row(3, publish_date="2020-05-05")]
    tables, _ = runs(spark, tmp_path, "moves", (first, "incremental"))
    folder = lambda v: {r["folder"] for r in tables._manifests().filter((F.col("version") == v) & (F.col("part") == 2020)).collect()}
    later = [raw_row(1, respondents="3000"), raw_row(2, respondents="3000"), raw_row(4)]
    version, c = R.commit_run(tables, R.clean_run(spark, tables, frame(spark, later), "reprocess"))
    polls = {r["raw_id"]: r for r in tables.read("polls", R.POLLS).collect()}
    assert (c["created"], c["updated"], c["skipped"]) == (1, 2, 0) and sorted(polls) == [1, 2, 3, 4]
    assert polls[1]["respondents"] == polls[2]["respondents"] == 3000 and polls[2]["fingerprint"] is None and polls[4]["respondents"] == 1000
    assert folder(version) & folder(version - 1) == folder(version)
    with pytest.raises(ValueError):
        R.clean_run(spark, tables, frame(spark, later), "other")


def test_landing_in_batches_equals_one_batch(spark, tmp_path):
    """Two landings, the second with rows of the first, and a batch that is run twice, end in the tables of one landing."""
    rows = [{**r, "seq": r["id"], "source": f"s{r['id'] % 40}"} for r in mixed(90, 3)]
    for r in rows:
        del r["id"]

    def landed(name, *parts):
        tables = Versions(spark, f"file://{tmp_path}/{name}/tables")
        for part in parts:
            spark.createDataFrame([json.dumps(r) for r in part], "string").write.mode("append").text(f"{tmp_path}/{name}/in")
            ingest_and_clean(spark, f"{tmp_path}/{name}/in", tables, f"{tmp_path}/{name}/c")
        return tables

    unlike = list({json.dumps({k: v for k, v in r.items() if k != "seq"}): r for r in reversed(rows)}.values())[::-1]
    batches, once = landed("parts", unlike[:50], unlike[30:]), landed("one", unlike)
    assert tables_of(batches) == tables_of(once) and tables_of(once)["polls"]
    raw = batches.read("raw", f"{R.RAW}, part int")
    assert raw.count() == len(unlike)
    before = batches.latest()
    assert not clean_batch(batches, raw.limit(3).withColumn("seq", F.col("id")), f"{tmp_path}/parts/c#1") and batches.latest() == before


def test_lost_run_leaves_the_version(spark, tmp_path):
    tables = Versions(spark, f"file://{tmp_path}/lost")
    polls, results = spark.createDataFrame([(1, 1, "x", 2024)], "id long, raw_id long, source string, part int"), spark.createDataFrame([(1, "SPD", 20.0, 2024)] * 3, R.RESULTS)
    tables.commit({"polls": Change(polls), "results": Change(results)})
    broken = tables.read("polls", R.POLLS).withColumn("source", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.commit({"results": Change(tables.read("results", R.RESULTS).limit(0)), "polls": Change(broken)})
    assert tables.latest() == 1 and tables.read("polls", R.POLLS).count() == 1 and tables.read("results", R.RESULTS).count() == 3
    two, again = Versions(spark, tables.root), Versions(spark, tables.root)
    two.latest()
    again.commit({}, tag="empty")
    assert again.latest() == 2 and again.tagged("empty") and not again.tagged("x") and tables.read("polls", R.POLLS).count() == 1


def test_relink_equals_linking_all(spark):
    """Five batches; after each the links near the changes, beside those that stay, are those of all polls."""
    cfg = M.MatchConfig(parties=("SPD", "AFD"))
    rnd, polls, now = random.Random(11), [], {}
    schema = "id long, publish_date date, provider string, scope string, institute string, election string, respondents int, survey_start date, survey_end date"

    def linked(p, r):
        a, b = (M.side(p, r, name, cfg) for name in ("primary", "secondary"))
        return M.link(a, b, M.choose(M.with_evidence(M.candidates(a, b, cfg), cfg), cfg))

    import datetime

    for _ in range(5):
        new = []
        for _ in range(60):
            day = datetime.date(2023, 10, 1) + datetime.timedelta(days=rnd.choice([*range(40), rnd.randrange(300)]))
            new.append((len(polls) + len(new) + 1, day, rnd.choice(["primary", "secondary"]), rnd.choice(["federal", None]), rnd.choice(["INSA", "FORSA", None]), None, rnd.choice([None, None, 1000]), None, None))
        polls += new
        p = spark.createDataFrame(polls, schema)
        r = spark.createDataFrame([(x[0], party, float(16 + x[0] % 3)) for x in polls if x[0] % 11 for party in ("SPD", "AFD")], "poll_id long, party string, percentage double")
        links, near = M.relink(p, r, spark.createDataFrame(new, schema).select("scope", "institute", "publish_date"), cfg, "primary", "secondary")
        fresh = {x["id"]: (x["status"], x["matched_id"]) for x in links.collect()}
        reached = {x["id"] for x in near.collect()}
        now = {i: v for i, v in now.items() if i not in reached} | fresh
        assert now == {x["id"]: (x["status"], x["matched_id"]) for x in linked(p, r).collect()}
    assert {s for s, _ in now.values()} == {"matched", "no_match", "multiple_matches", "missing_results"}
