"""One cleaning run: raw rows to polls, results, duplicates and counters, on versions of the tables (D1 to D10, E, F)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import survey as S
from ..session import stored
from ..sources.versions import Change, Versions
from . import clean as C, dedupe as D, match as M, select as P
from .joins import dense_numbers, join_groups

RAW = (
    "id long, publish_date string, survey_date_start string, survey_date_end string, respondents string, zeitraum string, parties string, institute_id string, provider string, source string, scope string, "
    "election_id string, method_id string, date_downloaded string"
)
#: What a poll says, by which it is told from others.
FIELDS = ("publish_date", "survey_start", "survey_end", "respondents", "institute", "provider", "method", "election", "source", "scope")
_CONTENT = "publish_date date, survey_start date, survey_end date, respondents int, institute string, provider string, method string, election string, source string, scope string"
POLLS = f"id long, raw_id long, {_CONTENT}, fingerprint string, date_downloaded timestamp, matching_poll_id long, matching_status string, is_public boolean, public_exclusion_reason string, part int"
RESULTS = "poll_id long, party string, percentage double, part int"
DUPLICATES = "id long, duplicate_of long, part int"
#: Raw ids in a partition of the duplicates.
RAW_IDS = 1_000_000


def year_part(date: str = "publish_date") -> Column:
    """The partition of a poll: its year of publication."""
    return F.coalesce(F.year(date), F.lit(0)).alias("part")


def clean_rows(raw: DataFrame) -> DataFrame:
    """C and D2 to D3 on raw rows: (id, reason, and of rows without one the fields of a poll, results, fingerprint, date_downloaded); no row meets another.

    What rejects a row is read first, in the order of the reasons, and of a rejected row nothing
    after it.  A column that several others use has a select of its own, or Spark puts what makes
    it into each of them.
    """
    repaired = S.unswapped(F.col("respondents"), F.col("zeitraum"))
    rows = raw.withColumns({"publish_date": S.publish_date(F.col("publish_date")), "repaired": repaired})
    window = S.survey_window(F.col("survey_date_start"), F.col("survey_date_end"), F.col("repaired.timeframe"), F.col("publish_date"))
    rows = rows.withColumn("window", F.when(F.col("publish_date").isNotNull(), window))
    rows = rows.withColumn("ignore", F.col("window.ignore")).withColumn("results", F.when(~F.col("ignore"), C.results_of(F.col("parties"))))
    rows = rows.withColumn("reason", C.rejection())
    good = F.col("reason").isNull()
    kept = lambda c: F.when(good, c)
    rows = rows.select(
        "id", "reason", "publish_date", kept(F.col("window.start")).alias("survey_start"), kept(F.col("window.end")).alias("survey_end"), kept(F.col("repaired.respondents")).alias("respondents_text"),
        kept(F.col("method_id")).alias("method_text"), "provider", "source", kept(F.col("results")).alias("results"), kept(S.respondents(F.col("repaired.respondents"))).alias("respondents"),
        kept(S.institute(F.col("institute_id"))).alias("institute"), kept(S.scope_code(F.col("scope"))).alias("scope"), kept(S.election(F.col("scope"), F.col("election_id"))["key"]).alias("election"),
        kept(S.timestamp(F.col("date_downloaded"))).alias("date_downloaded"),
    )
    rows = C.with_fallbacks(rows).select("id", "reason", *[kept(F.col(c)).alias(c) for c in FIELDS], "results", "date_downloaded")
    return rows.withColumn("fingerprint", kept(D.fingerprint({c: F.col(c) for c in FIELDS}, F.col("results"))))


def owners(rows: DataFrame, polls: DataFrame) -> DataFrame:
    """Which of the processed rows become polls, as if they came one by one in the order of their ids.

    rows: (id, fingerprint) of rows with results, polls: (id, raw_id, fingerprint), no two of
    one fingerprint.  Returns (id, existed, fingerprint, duplicate_of_raw): a row that has a
    poll updates it and is no duplicate.  At its turn an update gives up its old fingerprint
    and takes the new one; where another poll owns that one, its poll stays without.  A new row
    takes a fingerprint that no poll owns at its turn, else it is a duplicate of the owner.

    A row has one turn, so a fingerprint has at most two owners in a run: the poll that had it,
    up to its own turn if it then changes, and the first row after that.  Both are aggregates
    by fingerprint; a fingerprint of very many rows is joined by broadcast.
    """
    old = polls.select(F.col("raw_id").alias("id"), F.col("fingerprint").alias("old"), F.lit(True).alias("existed"))
    turns = stored(rows.select("id", "fingerprint").join(old, "id", "left").withColumn("existed", F.coalesce("existed", F.lit(False))), "turns")
    given_up = turns.filter(F.col("old") != F.col("fingerprint")).select(F.col("id").alias("raw_id"), F.lit(True).alias("leaves"))
    had = polls.filter("fingerprint is not null").join(given_up, "raw_id", "left").select("fingerprint", F.col("raw_id").alias("holder"), F.when(F.col("leaves"), F.col("raw_id")).alias("free_from"))
    seekers = turns.filter(~F.col("existed") | ~F.col("old").eqNullSafe(F.col("fingerprint")))
    sizes = seekers.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    groups = stored(sizes.join(had, "fingerprint", "left"), "fingerprints")
    total = turns.count()
    late = join_groups(seekers.select("id", "fingerprint"), groups.select("fingerprint", "n", "free_from"), ["fingerprint"], "n", total)
    taken = late.filter("id > free_from").groupBy("fingerprint").agg(F.min("id").alias("next"))
    owned = groups.join(taken, "fingerprint", "left").withColumn("next", F.when(F.col("holder").isNull() | (F.col("free_from") < F.col("first")), F.col("first")).otherwise(F.col("next")))
    sought = join_groups(seekers, stored(owned.select("fingerprint", "n", "holder", "free_from", "next"), "owners"), ["fingerprint"], "n", total)
    takes = F.coalesce(F.col("id") == F.col("next"), F.lit(False))
    owner = F.when(F.col("id") > F.col("next"), F.col("next")).otherwise(F.col("holder"))
    new = sought.select("id", "existed", F.when(takes, F.col("fingerprint")).alias("fingerprint"), F.when(~takes & ~F.col("existed"), owner).alias("duplicate_of_raw"))
    stays = turns.filter(F.col("existed") & F.col("old").eqNullSafe(F.col("fingerprint")))
    return new.unionByName(stays.select("id", "existed", "fingerprint", F.lit(None).cast("long").alias("duplicate_of_raw")))


@dataclass
class Counters:
    """What a run did, counted in the passes that write."""

    rows: Observation = field(default_factory=lambda: Observation("rows"))
    polls: Observation = field(default_factory=lambda: Observation("polls"))

    def decided(self, df: DataFrame) -> DataFrame:
        is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
        return df.observe(self.rows, F.count(F.lit(1)).alias("processed"), is_("created").alias("created"), is_("updated").alias("updated"), F.count_if(~F.col("outcome").isin("created", "updated")).alias("skipped"))

    def written(self, df: DataFrame, primary: str) -> DataFrame:
        mine = F.lower("provider") == primary.lower()
        status = lambda s: F.count_if(mine & (F.col("matching_status") == s))
        return df.observe(self.polls, status("matched").alias("matched"), status("multiple_matches").alias("ambiguous"), F.count_if("is_public").alias("public"), F.count_if(~F.col("is_public")).alias("excluded"))

    def get(self) -> dict[str, int]:
        return {**self.rows.get, **self.polls.get}


@dataclass(frozen=True)
class RunConfig:
    match: M.MatchConfig = M.MatchConfig()
    selection: P.SelectionConfig = P.SelectionConfig()


@dataclass
class Run:
    """What a run leaves: the touched partitions of each table, the rows' outcomes, and counters that are known once the tables are written."""

    changes: dict[str, Change]
    outcomes: DataFrame
    counters: Counters


def decide(raw: DataFrame, polls: DataFrame) -> DataFrame:
    """(id, outcome, duplicate_of_raw and the poll's fields, null where it was rejected) of each row that a run reads. Outcomes: created, updated, duplicate, or why a row was rejected."""
    rows = stored(clean_rows(raw), "cleaned")
    good = rows.filter("reason is null")
    outcome = F.when(F.col("existed"), "updated").when(F.col("duplicate_of_raw").isNotNull(), "duplicate").otherwise("created")
    shown = ("duplicate_of_raw", *FIELDS, "results", "fingerprint", "date_downloaded")
    decided = good.drop("fingerprint").join(owners(good, polls), "id", "left").select("id", outcome.alias("outcome"), *shown)
    # Rejected rows meet no others, so they are not shuffled.
    rejected = rows.filter("reason is not null").withColumn("duplicate_of_raw", F.lit(None).cast("long"))
    return decided.unionByName(rejected.select("id", F.col("reason").alias("outcome"), *shown))


def _parts_of(*frames: DataFrame) -> list[int]:
    """The partitions that rows of the frames are in: years, or blocks of raw ids; as many as a run touches."""
    out = set()
    for df in frames:
        out |= {r["part"] for r in df.select("part").distinct().collect()}
    return sorted(out)


def clean_run(spark: SparkSession, tables: Versions, raw: DataFrame, mode: str = "incremental", limit: int | None = None, cfg: RunConfig | None = None, version: int | None = None) -> Run:
    """Clean raw rows (RAW) over a version of the tables polls, results and duplicates.

    Missing fingerprints are filled first (D8, but in a rebuild), then the rows of the mode (D9)
    are cleaned and decided, polls and results of the touched years replaced, polls near a
    change relinked (E) and touched years' public records chosen (F).  Nothing is written to the
    tables: commit_run() does that.  A row that was a duplicate and is none any more is taken
    off the duplicates.  Raw ids are unique.
    """
    cfg = cfg or RunConfig()
    at = tables.latest() if version is None else version
    polls, results, duplicates = (tables.read(name, schema, at) for name, schema in (("polls", POLLS), ("results", RESULTS), ("duplicates", DUPLICATES)))
    old_polls = polls
    filled = spark.createDataFrame([], "id long, fingerprint string, part int")
    if mode != "rebuild" and not polls.filter("fingerprint is null").isEmpty():
        polls = stored(D.backfill(polls, _fingerprints(polls.filter("fingerprint is null"), results)), "backfilled")
        filled = polls.join(old_polls.filter("fingerprint is null").select("id"), "id", "left_semi").filter("fingerprint is not null")
    rows, before = D.select_run(raw, polls, duplicates, mode, limit)
    counters = Counters()
    decided = stored(counters.decided(decide(rows, before.select("id", "raw_id", "fingerprint"))), "decided")

    known = before.select("id", "raw_id")
    made = dense_numbers(decided.filter("outcome = 'created'").select(F.col("id").alias("raw_id")), ["raw_id"])
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    ids = stored(known.unionByName(made.crossJoin(F.broadcast(top)).select((F.col("top") + F.col("n")).cast("long").alias("id"), "raw_id")), "poll-ids")

    good = decided.filter("outcome in ('created', 'updated')").withColumnRenamed("id", "raw_id").join(ids, "raw_id")
    fresh = good.select("id", "raw_id", *FIELDS, "fingerprint", "date_downloaded", year_part(), "results")
    fresh = stored(fresh, "fresh-polls")
    replaced = before.join(fresh.select("id"), "id", "left_semi")
    blank = {"matching_poll_id": "long", "matching_status": "string", "is_public": "boolean", "public_exclusion_reason": "string"}
    kept = before.join(fresh.select("id"), "id", "left_anti")
    now = kept.unionByName(fresh.drop("results").withColumns({c: F.lit(None).cast(t) for c, t in blank.items()}))
    new_results = fresh.select(F.col("id").alias("poll_id"), F.explode("results").alias("r"), "part").select("poll_id", "r.party", "r.percentage", "part")
    kept_results = (results.filter(F.lit(False)) if mode == "rebuild" else results).join(fresh.select(F.col("id").alias("poll_id")), "poll_id", "left_anti")
    now_results = kept_results.unionByName(new_results)

    changed = stored(replaced.select("publish_date", "scope", "institute", "part").unionByName(fresh.select("publish_date", "scope", "institute", "part")), "changed")
    # What a change reaches lies less than a year from it, so other years are not read.
    own = _parts_of(changed)
    years = F.col("part").isin([p + i for p in own for i in (-1, 0, 1)])
    links, near = M.relink(now.filter(years), now_results.filter(years), changed, cfg.match, cfg.selection.primary, cfg.selection.secondary)
    near = near.select("id")
    reach = M.reach(cfg.match)
    around = changed.select(F.explode(F.array(*[F.year(F.date_add("publish_date", i)) for i in (-reach, reach)])).alias("part"))
    parts = None if mode == "rebuild" else sorted({*own, *_parts_of(around, filled)})
    changes = {}
    linked = _selected(_linked(now if parts is None else now.filter(F.col("part").isin(parts)), links, near), cfg.selection)
    changes["polls"] = Change(counters.written(linked.select(*old_polls.columns), cfg.selection.primary), parts)
    result_parts = None if parts is None else own
    changes["results"] = Change(now_results if result_parts is None else now_results.filter(F.col("part").isin(result_parts)), result_parts)
    block = F.floor(F.col("id") / RAW_IDS).cast("int").alias("part")
    holders = ids.select(F.col("raw_id").alias("duplicate_of_raw"), F.col("id").alias("duplicate_of"))
    new_duplicates = decided.filter("outcome = 'duplicate'").select("id", "duplicate_of_raw").join(holders, "duplicate_of_raw").select("id", "duplicate_of", block)
    kept_duplicates = (duplicates.filter(F.lit(False)) if mode == "rebuild" else duplicates).join(decided.select("id"), "id", "left_anti")
    seen = None if mode == "rebuild" else _parts_of(decided.select("id", block))
    all_duplicates = kept_duplicates.unionByName(new_duplicates)
    changes["duplicates"] = Change(all_duplicates if seen is None else all_duplicates.filter(F.col("part").isin(seen)), seen)
    return Run(changes, decided.select("id", "outcome", "duplicate_of_raw"), counters)


def _fingerprints(polls: DataFrame, results: DataFrame) -> DataFrame:
    """(id, fingerprint) of polls from what is stored of them."""
    nested = results.join(polls.select(F.col("id").alias("poll_id")), "poll_id", "left_semi").groupBy("poll_id").agg(F.array_sort(F.collect_list(F.struct("party", "percentage"))).alias("results"))
    rows = polls.join(nested, F.col("id") == F.col("poll_id"))
    return rows.select("id", D.fingerprint({c: F.col(c) for c in FIELDS}, F.col("results")).alias("fingerprint"))


def _linked(polls: DataFrame, links: DataFrame, near: DataFrame) -> DataFrame:
    """polls with the new links of those near a change, which lose theirs where there is none any more."""
    reset = near.select("id", F.lit(True).alias("__near"))
    rows = polls.join(reset, "id", "left").join(links.select("id", F.col("status").alias("__status"), F.col("matched_id").alias("__matched")), "id", "left")
    for c, new in (("matching_status", "__status"), ("matching_poll_id", "__matched")):
        rows = rows.withColumn(c, F.when(F.col("__near"), F.col(new)).otherwise(F.col(c)))
    return rows.drop("__near", "__status", "__matched")


def _selected(polls: DataFrame, cfg: P.SelectionConfig) -> DataFrame:
    chosen = P.select_public(polls.withColumn("status", F.col("matching_status")), cfg)
    return chosen.withColumn("public_exclusion_reason", F.col("reason")).drop("status", "reason")


def commit_run(tables: Versions, run: Run, more: dict[str, Change] | None = None, tag: str | None = None) -> tuple[int, dict[str, int]]:
    """Write a run as the next version of the tables; returns (the version, the counters). The counters of links and public records are of the partitions written."""
    version = tables.commit({**run.changes, **(more or {})}, tag)
    return version, run.counters.get()


def dry_run(run: Run) -> dict[str, int]:
    """The counters of a run that leaves the tables alone."""
    for change in run.changes.values():
        change.rows.write.format("noop").mode("overwrite").save()
    return run.counters.get()
