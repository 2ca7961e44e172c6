"""Serving views (H)."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.survey import public_election_key, public_election_name, public_id, scope_code
from ..vocab import RAW_NAMES
from .select import GatePolicy, serving_gate


def filter_polls(polls: DataFrame, *, scopes=None, institutes=None, elections=None, methods=None, provider_id=None, provider=None, source=None, date_from=None, date_to=None) -> DataFrame:
    """H1 and H2: all given conditions.  Scopes are any names of areas (C14); keys are trimmed and capitalised; dates are inclusive and must be in order.  An empty list is no condition; keys that are all blank are one that no poll meets."""
    if date_from is not None and date_to is not None and date_from > date_to:
        raise ValueError("date_from is after date_to")
    out = polls
    if scopes:
        out = out.filter(reduce(lambda a, b: a | b, [F.col("scope") == scope_code(F.lit(s)) for s in scopes]))
    for column, wanted in (("institute", institutes), ("election", elections), ("method", methods)):
        if wanted:
            out = out.filter(F.col(column).isin([k.strip().upper() for k in wanted if k.strip()]))
    if provider_id is not None:
        out = out.filter(F.col("provider_id") == provider_id)
    if provider:
        out = out.filter(F.lower("provider") == provider.lower())
    if source:
        out = out.filter(F.col("source") == source)
    if date_from is not None:
        out = out.filter(F.col("publish_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        out = out.filter(F.col("publish_date") <= F.lit(date_to).cast("date"))
    return out


def sort_polls(polls: DataFrame, by: str = "publish_date", descending: bool = True) -> DataFrame:
    """H3: by date or id, id breaks ties; rows of a poll's parties (H8) stand by party."""
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in dict.fromkeys((by, "id"))]
    return polls.orderBy(*order, *[F.col(c).asc() for c in ("party",) if c in polls.columns])


def page(polls: DataFrame, offset: int, limit: int) -> DataFrame:
    """H4: one page in date order with its place, the total and has_next.  Offset and limit push a top-k into Spark; the total is one aggregate."""
    total = polls.agg(F.count("*").alias("total"))
    rows = sort_polls(polls).offset(offset).limit(limit)
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("publish_date"), F.desc("id"))) + offset
    return rows.withColumn("place", place).crossJoin(F.broadcast(total)).withColumn("has_next", F.col("total") > offset + limit)


def enriched(polls: DataFrame, raw: DataFrame, institutes: DataFrame, providers: DataFrame, elections: DataFrame, methods: DataFrame) -> DataFrame:
    """H5: polls with public ids, the raw row's and the matched poll's, and the names of institute, provider, election and method; what isn't found is null.

    institutes, elections and methods have key and name (elections: type), providers id and
    name; raw has id.  Spark broadcasts those that are small; the self join is by id.
    """
    named = lambda dim, key, **columns: dim.select(F.col(key).alias(f"__{key}"), *[F.col(c).alias(name) for name, c in columns.items()])
    out = polls.withColumn("public_id", public_id("C", F.col("id")))
    for column, dim in (
        ("raw_id", raw.select(F.col("id").alias("__key"), public_id("R", F.col("id")).alias("raw_public_id"))), ("institute", named(institutes, "key", institute_name="name")), ("method", named(methods, "key", method_name="name")),
        ("provider_id", named(providers, "id", provider_name="name").withColumnRenamed("__id", "__key")), ("election", named(elections, "key", election_type="type")),
        ("matching_poll_id", polls.select(F.col("id").alias("__key"), public_id("C", F.col("id")).alias("matching_poll_public_id"))),
    ):
        out = out.join(dim, F.col(column) == F.col("__key"), "left").drop("__key")
    return out.withColumns({"election": public_election_key(F.col("election")), "election_type": public_election_name(F.col("election_type"))})


#: Columns that public rows don't show.
INTERNAL = ("fingerprint", "is_public", "public_exclusion_reason")


def without_results(polls: DataFrame, internal: bool = False) -> DataFrame:
    """H9: poll rows without nested results; the audit dump (internal) shows the internal columns too."""
    return polls.drop("results", *(() if internal else INTERNAL))


DATASETS = ("default", "all-cleaned")


def dataset(name: str, polls: DataFrame, validations: DataFrame, policy: GatePolicy, **filters) -> DataFrame:
    """The polls of a named dataset under the filters of H1: default passes the serving gate, all-cleaned is everything."""
    if name not in DATASETS:
        raise ValueError(f"no dataset {name!r}")
    rows = filter_polls(polls, **filters)
    return serving_gate(rows, validations, policy) if name == "default" else rows


def nested_results(results: DataFrame) -> DataFrame:
    """H6: sorted (party, percentage) array by poll."""
    return results.groupBy("poll_id").agg(F.array_sort(F.collect_list(F.struct("party", "percentage"))).alias("results"))


def wide_results(results: DataFrame) -> DataFrame:
    """H7: party to percentage map by poll."""
    return nested_results(results).select("poll_id", F.map_from_entries("results").alias("results"))


def observations(polls: DataFrame, results: DataFrame, parties: list[str] | None = None) -> DataFrame:
    """H8: a row for each poll and party."""
    r = results if parties is None else results.filter(F.col("party").isin(parties))
    return polls.join(r, polls["id"] == r["poll_id"]).drop("poll_id")


def latest(polls: DataFrame, n: int, scope=None) -> DataFrame:
    """The n latest polls; undated ones come last."""
    return sort_polls(polls if scope is None else polls.filter(F.col("scope") == scope)).limit(n)


def lookup(polls: DataFrame, key: str, validations: DataFrame | None = None, policy: GatePolicy | None = None) -> DataFrame:
    """By C… or R… public id, any case, or by digits; anything else is an error.  With validations only what passes the serving gate is found."""
    m = re.fullmatch(r"([CcRr]?)(\d+)", key.strip())
    if not m:
        raise ValueError(f"no poll id: {key!r}")
    found = polls.filter(F.col("raw_id" if m[1].upper() == "R" else "id") == int(m[2]))
    return found if validations is None else serving_gate(found, validations, policy or GatePolicy())


def raw_audit(raw: DataFrame, *, source=None, scope=None, provider=None, worker=None) -> DataFrame:
    """Raw rows in id order under English names, with their public ids, of one source, scope, provider and worker where given."""
    rows = raw
    for column, wanted in (("source", source), ("scope", scope), ("provider", provider), ("worker", worker)):
        if wanted is not None:
            rows = rows.filter(F.col(column) == wanted)
    return rows.withColumn("public_id", public_id("R", F.col("id"))).withColumnsRenamed({k: v for k, v in RAW_NAMES.items() if k in rows.columns}).orderBy("id")


def scopes_list(elections: DataFrame) -> DataFrame:
    """(key, election_key, election_type) of each election (key, scope, type): its scope, else its key in small letters, and its public names."""
    return elections.select(F.coalesce("scope", F.lower("key")).alias("key"), public_election_key(F.col("key")).alias("election_key"), public_election_name(F.col("type")).alias("election_type"))


def reference_list(dim: DataFrame, by: str) -> DataFrame:
    """A dimension in the order of its key or id."""
    return dim.orderBy(by)


def reference_lists(dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """All dimensions (frame, key column, name column) as one, by kind and key; keys as text."""
    parts = [df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.col(name).alias("name")) for kind, (df, key, name) in dims.items()]
    return reduce(DataFrame.unionByName, parts)


def validation_list(validations: DataFrame, valid: bool | None = None, poll_id: int | None = None) -> DataFrame:
    """Validation rows by poll id, valid or invalid ones only where asked for, or the report of one poll."""
    rows = validations if valid is None else validations.filter(F.col("valid") == valid)
    return (rows if poll_id is None else rows.filter(F.col("poll_id") == poll_id)).orderBy("poll_id")


def election_summary(elections: DataFrame, polls: DataFrame, key: str) -> DataFrame:
    """Every election with its number of polls, 0 kept, and the latest date."""
    per = polls.groupBy(key).agg(F.count("*").alias("polls"), F.max("publish_date").alias("latest"))
    return elections.join(per, key, "left").withColumn("polls", F.coalesce("polls", F.lit(0)).cast("long"))


NOT_CONFIGURED = "not configured"


def year_report(polls: DataFrame, validated: DataFrame, by_year: dict[int, dict[str, str]], default: dict[str, str] | None = None) -> DataFrame:
    """By year (year, primary_provider, primary_source, polls, validated, primary_polls) of the dated polls (provider, source).

    by_year and default may give ``provider`` and ``source``; what a year doesn't give is the
    default's, else ``not configured``, which is no condition on the primary polls.
    """
    year, given = F.year("publish_date"), {}
    for name in ("provider", "source"):
        own = F.when(F.lit(False), "")
        for y, config in by_year.items():
            if config.get(name):
                own = own.when(year == y, config[name])
        given[name] = own.otherwise((default or {}).get(name) or NOT_CONFIGURED)
    rows = polls.filter("publish_date is not null").select("id", "provider", "source", year.alias("year"), *[c.alias(f"primary_{name}") for name, c in given.items()])
    rows = rows.join(validated.select(F.col("poll_id").alias("id"), F.lit(True).alias("seen")), "id", "left")
    primary = F.lit(True)
    for name in given:
        primary = primary & ((F.col(f"primary_{name}") == NOT_CONFIGURED) | F.coalesce(F.col(name) == F.col(f"primary_{name}"), F.lit(False)))
    return rows.groupBy("year", "primary_provider", "primary_source").agg(F.count("*").alias("polls"), F.count_if("seen").alias("validated"), F.count_if(primary).alias("primary_polls"))


def freshness(polls: DataFrame, runs: DataFrame, quality: DataFrame, now: Column) -> DataFrame:
    """Total polls, the last run and its age in seconds, and the worst of the run's status (warn without a run) and the validation's (quality: G15)."""
    out = polls.agg(F.count("*").alias("polls")).crossJoin(runs.agg(F.max("ended").alias("last_run"))).crossJoin(quality.select(F.col("status").alias("validation_status")))
    run = F.when(F.col("last_run").isNull(), "warn").otherwise("pass")
    both = F.array(run, F.col("validation_status"))
    status = F.when(F.array_contains(both, "fail"), "fail").when(F.array_contains(both, "warn"), "warn").otherwise("pass")
    return out.withColumns({"age": F.unix_timestamp(now) - F.unix_timestamp("last_run"), "run_status": run, "status": status})


def report_totals(polls: DataFrame, quality: DataFrame, run: DataFrame) -> DataFrame:
    """Polls, validated, valid, invalid and warning ones with the valid share and status (quality: G15), and the counters of a run (H21; 0 if there is none)."""
    totals = polls.agg(F.count("*").alias("polls")).crossJoin(quality.select(F.col("total").alias("validated"), "valid", "invalid", F.col("with_warning").alias("warning"), "valid_share", "status"))
    counters = run.agg(F.max("run_id").alias("run_id"), *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("scraped", "created", "updated", "errors")])
    return totals.crossJoin(counters.withColumn("run_id", F.coalesce("run_id", F.lit("not connected"))))


def run_records(steps: DataFrame) -> DataFrame:
    """One audit row a run from its steps (run_id, stage, started, ended, n, failed): times, duration in seconds, success, rows by stage and errors."""
    stages = ("scraped", "created", "updated")
    return steps.groupBy("run_id").agg(
        F.min("started").alias("started"), F.max("ended").alias("finished"), (F.unix_timestamp(F.max("ended")) - F.unix_timestamp(F.min("started"))).alias("duration"), (F.count_if("failed") == 0).alias("success"),
        *[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)).alias(s) for s in stages], F.count_if("failed").alias("errors"),
    )


def append_runs(history: DataFrame, new: DataFrame) -> DataFrame:
    """History with the runs of new that it doesn't hold yet."""
    return history.unionByName(new.join(history.select("run_id"), "run_id", "left_anti"))


def run_of(history: DataFrame, run_id: str | None = None) -> DataFrame:
    """A run by its id, or the one that finished last."""
    if run_id is not None:
        return history.filter(F.col("run_id") == run_id)
    return history.orderBy(F.desc("finished"), F.desc("run_id")).limit(1)
