"""Quality checks (G)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.survey import public_id
from ..session import stored


def range_check(polls: DataFrame, results: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    """G1: has results, all inside the range; offenders by name."""
    bad = ~F.col("percentage").between(low, high)
    per = results.groupBy("poll_id").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(F.when(bad, F.col("party")))), ",").alias("offenders"))
    return polls.select("id").join(per, F.col("id") == F.col("poll_id"), "left").select("id", F.coalesce((F.col("n") > 0) & (F.col("offenders") == ""), F.lit(False)).alias("passed"), F.coalesce("offenders", F.lit("")).alias("offenders"))


def sum_check(polls: DataFrame, results: DataFrame, total: float = 100, tolerance: float = 2) -> DataFrame:
    """Has results that sum to the total within the tolerance, bounds included."""
    per = results.groupBy("poll_id").agg(F.sum("percentage").alias("observed"))
    return polls.select("id").join(per, F.col("id") == F.col("poll_id"), "left").select("id", F.coalesce(F.col("observed").between(total - tolerance, total + tolerance), F.lit(False)).alias("passed"), F.round("observed", 2).alias("observed"))


def date_message(today: Column) -> Column:
    """What is wrong with start, end and publication: missing, out of order, after today; else ok."""
    missing = F.col("survey_start").isNull() | F.col("survey_end").isNull() | F.col("publish_date").isNull()
    ordered = (F.col("survey_start") <= F.col("survey_end")) & (F.col("survey_end") <= F.col("publish_date"))
    future = F.greatest("survey_start", "survey_end", "publish_date") > today
    return F.when(missing, "missing dates").when(~ordered, "dates out of order").when(future, "date in the future").otherwise("ok")


def date_check(polls: DataFrame, today: Column) -> DataFrame:
    """Start, end and publication in order, none missing, none after today."""
    message = date_message(today)
    return polls.select("id", (message == "ok").alias("passed"), message.alias("message"))


def respondents_check(polls: DataFrame, bounds: DataFrame, unknown: str) -> DataFrame:
    """Count inside its method's bounds (low, high; a table of one row a method); a null method counts as ``unknown``, a null count fails."""
    return polls.withColumn("method", F.coalesce("method", F.lit(unknown))).join(F.broadcast(bounds), "method", "left").select("id", F.coalesce(F.col("respondents").between(F.col("low"), F.col("high")), F.lit(False)).alias("passed"))


def expected_list(rules: list[tuple[str, list[str], int | None, int | None]], group: Column) -> Column:
    """The parties expected by rules (scope group, parties, from year, until year); undated polls ignore years."""
    wanted = []
    year = F.year("publish_date")
    for scope, parties, first, last in rules:
        ok = F.lit(True) if scope == "*" else group.contains(f"|{scope}|")
        if first is not None:
            ok = ok & (year.isNull() | (year >= first))
        if last is not None:
            ok = ok & (year.isNull() | (year <= last))
        wanted.append(F.when(ok, F.array(*[F.lit(p) for p in parties])).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.flatten(F.array(*wanted))))


def expected_parties(polls: DataFrame, rules: list[tuple[str, list[str], int | None, int | None]], group: Column) -> DataFrame:
    """(id, party): a row for each expected party."""
    return polls.select("id", F.explode(expected_list(rules, group)).alias("party"))


def presence(polls: DataFrame, results: DataFrame, parties: list[str], days: int = 365) -> DataFrame:
    """Per poll and monitored party how many other polls of its scope within the window there are, and how many have the party. Undated polls compare with their whole scope."""
    have = results.filter(F.col("party").isin(parties)).groupBy(F.col("poll_id").alias("id")).agg(F.collect_set("party").alias("have"))
    rows = polls.select("id", "scope", "publish_date").join(have, "id", "left")
    rows = with_presence(rows.withColumn("have", F.coalesce("have", F.array().cast("array<string>"))), parties, days)
    return rows.select("id", F.explode("nearby").alias("p")).select("id", "p.party", "p.has", "p.comparisons", "p.with_party")


def with_presence(rows: DataFrame, parties: list[str], days: int = 365) -> DataFrame:
    """Rows (scope, publish_date, have: the poll's parties) with ``nearby``, an array of (party, has, comparisons, with_party).

    Polls are counted by scope and day first, so the windows run over days, however many
    polls a scope has.
    """
    rows = rows.withColumn("day", F.datediff("publish_date", F.lit("1970-01-01")))
    holding = [F.count_if(F.array_contains("have", p)).alias(f"k{i}") for i, p in enumerate(parties)]
    by_day = rows.groupBy("scope", "day").agg(F.count("*").alias("n"), *holding)
    near, everything = W.partitionBy("scope").orderBy("day").rangeBetween(-days, days), W.partitionBy("scope")
    undated = F.col("day").isNull()

    def around(c: str) -> Column:
        return F.when(undated, F.sum(c).over(everything)).otherwise(F.sum(F.when(~undated, F.col(c))).over(near))

    counts = by_day.select(F.col("scope").alias("__scope"), F.col("day").alias("__day"), around("n").alias("around"), F.array(*[around(f"k{i}") for i in range(len(parties))]).alias("holding"))
    rows = rows.join(counts, F.col("scope").eqNullSafe(F.col("__scope")) & F.col("day").eqNullSafe(F.col("__day")))

    def one(i: int, party: str) -> Column:
        has = F.array_contains("have", party).cast("int")
        return F.struct(F.lit(party).alias("party"), has.alias("has"), (F.col("around") - 1).cast("long").alias("comparisons"), (F.get("holding", F.lit(i)) - has).cast("long").alias("with_party"))

    return rows.withColumn("nearby", F.array(*[one(i, p) for i, p in enumerate(parties)])).drop("day", "__scope", "__day", "around", "holding")


def core_party_check(polls: DataFrame, expected: DataFrame, counts: DataFrame, min_polls: int = 5, min_share: float = 0.8, policy: bool = True) -> DataFrame:
    """Missing expected parties; those usual nearby fail the poll, the others warn."""
    missing = expected.join(counts, ["id", "party"]).filter("has = 0")
    block = ((F.col("comparisons") >= min_polls) & (F.col("with_party") >= min_share * F.col("comparisons"))) if policy else F.lit(True)
    per = missing.groupBy("id").agg(F.array_join(F.sort_array(F.collect_list(F.when(block, F.col("party")))), ",").alias("blocking"), F.array_join(F.sort_array(F.collect_list(F.when(~block, F.col("party")))), ",").alias("context"))
    rows = polls.select("id").join(per, "id", "left").fillna({"blocking": "", "context": ""})
    return rows.select("id", (F.col("blocking") == "").alias("passed"), F.when(F.col("blocking") != "", "error").when(F.col("context") != "", "warning").otherwise("info").alias("severity"), "blocking", "context")


def _previous(rows: DataFrame) -> DataFrame:
    """rows (kind, g, party, publish_date, id, percentage) with ``previous``, (percentage, id) of the party in the poll before of its group, by date, undated first, then id.

    A window is a year of a party in a group; each year's last value is carried over to the
    first poll of the next year that has one, so no task sorts a group's whole history.
    """
    rows = rows.withColumn("year", F.coalesce(F.year("publish_date"), F.lit(-1_000_000)))
    keys, value = ["kind", "g", "party"], F.struct("percentage", "id")
    by_year = rows.groupBy(*keys, "year").agg(F.max_by(value, F.struct(F.coalesce("publish_date", F.lit("0001-01-01").cast("date")), "id")).alias("last"))
    carried = by_year.select(*keys, "year", F.lag("last").over(W.partitionBy(*keys).orderBy("year")).alias("carried"))
    order = W.partitionBy(*keys, "year").orderBy(F.col("publish_date").asc_nulls_first(), "id")
    rows = rows.withColumn("before", F.lag(value).over(order)).withColumn("first", F.row_number().over(order) == 1).join(carried, [*keys, "year"])
    return rows.withColumn("previous", F.when(F.col("first"), F.col("carried")).otherwise(F.col("before")))


def jumps_of(rows: DataFrame, groups: dict[str, str], threshold: float = 4.0) -> DataFrame:
    """G8 and G9 in one pass: (id, kind, jumps) of polls (id, publish_date, results, the groups' columns) that jump. groups: column by kind.

    jumps is an array of (party_key, jump, current, previous, previous_poll_id,
    previous_public_id) by party: where its value is more than the threshold from that of the
    poll before of the same group.  A null or empty group is compared with nothing.
    """
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("g")) for kind, c in groups.items()])
    rel = rows.select("id", "publish_date", F.explode("results").alias("r"), kinds.alias("kinds")).select("id", "publish_date", "r.party", "r.percentage", F.explode("kinds").alias("k")).select("*", "k.kind", "k.g")
    rel = _previous(rel.filter(F.coalesce("g", F.lit("")) != "").drop("k"))
    change = F.col("percentage") - F.col("previous.percentage")
    jump = F.struct(
        F.col("party").alias("party_key"), F.round(change, 2).alias("jump"), F.col("percentage").alias("current"), F.col("previous.percentage").alias("previous"), F.col("previous.id").alias("previous_poll_id"),
        public_id("C", F.col("previous.id")).alias("previous_public_id"),
    )
    return rel.filter(F.abs(change) > threshold).groupBy("id", "kind").agg(F.array_sort(F.collect_list(jump)).alias("jumps"))


def jump_check(polls: DataFrame, results: DataFrame, group: str, threshold: float = 4.0) -> DataFrame:
    """Change of a party from the previous poll of its group above the threshold; polls without a group pass."""
    rows = polls.select("id", "publish_date", group).join(results.select(F.col("poll_id").alias("id"), F.array(F.struct("party", "percentage")).alias("results")), "id")
    jumps = jumps_of(rows, {group: group}, threshold).select("id", "jumps")
    size = F.coalesce(F.size("jumps"), F.lit(0))
    return polls.select("id").join(jumps, "id", "left").select("id", (size <= 0).alias("passed"), F.greatest(size, F.lit(0)).cast("long").alias("jumps"), F.array_max(F.transform("jumps", lambda j: F.abs(j["current"] - j["previous"]))).alias("largest"))


@dataclass(frozen=True)
class CheckConfig:
    """Limits of the checks; groups: the columns of an institute and a scope."""

    low: float = 0
    high: float = 100
    total: float = 100
    tolerance: float = 2
    jump: float = 4.0
    min_polls: int = 5
    min_share: float = 0.8
    days: int = 365
    groups: tuple[str, str] = ("institute", "scope")


def _shown(x: float) -> str:
    return f"{x:.0f}"


def check_structs(polls: DataFrame, results: DataFrame, bounds: DataFrame, unknown_method: str, rules: list, group: Column, monitored: list[str], today: Column, cfg: CheckConfig | None = None) -> DataFrame:
    """G1 to G9 at once: (poll_id, a struct for each check): passed, severity, observed (a VARIANT), expected, message (null if there is nothing to say) and affected_parties.

    Polls and results are joined once and stored; the checks of a poll on its own are
    expressions of that row, presence is counted by day, and both jump checks are one pass.
    """
    cfg = cfg or CheckConfig()
    listed = results.groupBy("poll_id").agg(F.array_sort(F.collect_list(F.struct("party", "percentage"))).alias("results"))
    rows = polls.join(listed, F.col("id") == F.col("poll_id"), "left").drop("poll_id").withColumn("results", F.coalesce("results", F.array().cast("array<struct<party:string,percentage:double>>")))
    rows = rows.withColumn("method", F.coalesce("method", F.lit(unknown_method))).join(F.broadcast(bounds), "method", "left").withColumns({"expected": expected_list(rules, group), "have": F.transform("results", lambda r: r["party"])})
    # As many files as the session has shuffle partitions, so that what follows is done in parallel.
    rows = stored(rows.repartition(int(polls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id"), "polls-with-results")
    kinds = dict(zip(CHECKS[5:], cfg.groups, strict=True))
    jumps = jumps_of(rows, kinds, cfg.jump).groupBy("id").agg(*[F.first(F.when(F.col("kind") == k, F.col("jumps")), ignorenulls=True).alias(k) for k in kinds])
    out = with_presence(rows, monitored, cfg.days).join(jumps.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left")

    parties = F.array().cast("array<string>")
    names = lambda c: F.transform(c, lambda x: x["party"])
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    def check(name: str, passed: Column, observed: Column, expected: Column, message: Column, affected: Column = parties, severity: Column | None = None) -> Column:
        return F.struct(passed.alias("passed"), (severity if severity is not None else F.lit(SEVERITY[name])).alias("severity"), observed.alias("observed"), expected.alias("expected"), message.alias("message"), affected.alias("affected_parties")).alias(name)

    some = F.size("results") > 0
    outside = F.filter("results", lambda r: ~r["percentage"].between(cfg.low, cfg.high))
    in_range = some & (F.size(outside) == 0)
    total = F.aggregate("results", F.lit(0.0), lambda s, r: s + r["percentage"])
    sums = some & total.between(cfg.total - cfg.tolerance, cfg.total + cfg.tolerance)
    wrong = date_message(today)
    dates = F.to_variant_object(F.struct(*[F.col(c).cast("string").alias(n) for c, n in (("survey_start", "survey_date_start"), ("survey_end", "survey_date_end"), ("publish_date", "publish_date"))]))
    plausible = F.coalesce(F.col("respondents").between(F.col("low"), F.col("high")), F.lit(False))
    missing = F.array_sort(F.array_except("expected", "have"))
    usual = F.filter("nearby", lambda p: (p["has"] == 0) & (p["comparisons"] >= cfg.min_polls) & (p["with_party"] >= cfg.min_share * p["comparisons"]))
    blocking = F.array_sort(F.array_intersect(missing, names(usual)))
    blocked, open_ = F.size(blocking) > 0, F.size(missing) > 0
    # What the checks expect and say.
    structs = [
        check(CHECKS[0], in_range, F.to_variant_object(F.map_from_entries("results")), text(f"Each party percentage must be between {_shown(cfg.low)} and {_shown(cfg.high)}."), F.when(~in_range, "One or more party percentages are outside the allowed range."), names(outside)),
        check(CHECKS[1], sums, F.round(total, 2).cast("variant"), text(f"Sum between {_shown(cfg.total - cfg.tolerance)} and {_shown(cfg.total + cfg.tolerance)}."), F.when(~sums, "Party results do not sum to 100 within tolerance.")),
        check(CHECKS[2], wrong == "ok", dates, text("survey_date_start <= survey_date_end <= publish_date; no future dates."), F.when(wrong == "missing dates", "One or more required dates are missing.").when(wrong != "ok", "Poll dates are inconsistent or in the future.")),
        check(CHECKS[3], plausible, F.col("respondents").cast("variant"), text(F.col("method"), ": respondents between ", F.col("low").cast("string"), " and ", F.col("high").cast("string"), "."), F.when(~plausible, "Respondent count is missing or outside plausible range.")),
        check(
            CHECKS[4], ~blocked, F.to_variant_object(F.array_sort("have")), text("Contextual core parties present: ", F.array_join("expected", ", "), "."),
            F.when(blocked, "One or more contextually expected core parties are missing.").when(open_, "One or more monitored core parties are missing, but nearby polls do not make this a blocking issue."),
            F.when(blocked, blocking).otherwise(missing), F.when(open_ & ~blocked, "warning").otherwise("error"),
        ),
    ]
    none = F.array().cast("array<struct<party_key:string,jump:double,current:double,previous:double,previous_poll_id:bigint,previous_public_id:string>>")
    for (name, column), said in zip(kinds.items(), ("institute", "scope"), strict=True):
        grouped, found = F.coalesce(F.col(column).cast("string"), F.lit("")) != "", F.coalesce(name, none)
        structs.append(check(
            name, F.size(found) == 0, F.when(grouped, F.to_variant_object(found)), F.when(grouped, f"No party jump greater than {_shown(cfg.jump)} percentage points.").otherwise(f"Previous poll with same {said}."),
            F.when(~grouped, f"No {said} value available for jump check.").when(F.size(found) > 0, f"Large party result jump within same {said}."), F.transform(found, lambda j: j["party_key"]),
        ))
    return out.select(F.col("id").alias("poll_id"), *structs)


def check_flags(polls: DataFrame, results: DataFrame, bounds: DataFrame, unknown_method: str, rules: list, group: Column, monitored: list[str], today: Column, cfg: CheckConfig | None = None) -> DataFrame:
    """(poll_id, the seven flags, checks: the struct of the seven structs)."""
    return flags_of(check_structs(polls, results, bounds, unknown_method, rules, group, monitored, today, cfg))


def flags_of(structs: DataFrame) -> DataFrame:
    return structs.select("poll_id", *[F.col(f"{c}.passed").alias(c) for c in CHECKS], F.struct(*CHECKS).alias("checks"))


CHECKS = ["qc_range", "qc_sum", "qc_dates", "qc_respondents", "qc_core", "qc_jump_institute", "qc_jump_scope"]
SEVERITY = {"qc_range": "error", "qc_sum": "error", "qc_dates": "error", "qc_respondents": "error", "qc_core": "error", "qc_jump_institute": "warning", "qc_jump_scope": "warning"}


def research_ready(required: list[str] | None = None) -> Column:
    """All required checks pass; without a list, all of severity error. An unknown name is an error."""
    names = required if required is not None else [c for c in CHECKS if SEVERITY[c] == "error"]
    if unknown := set(names) - set(CHECKS):
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    out = F.lit(True)
    for c in names:
        out = out & F.col(c)
    return out


def validation_rows(flags: DataFrame, required: list[str] | None = None, validated_at: Column | None = None) -> DataFrame:
    """Flags by poll with error and warning counts, validity, JSON details (the structs of the checks; without them the flags) and, if given, the time."""
    count = lambda s: sum((F.when(~F.col(c), 1).otherwise(0) for c in CHECKS if SEVERITY[c] == s), F.lit(0))
    details = F.to_json("checks" if "checks" in flags.columns else F.struct(*CHECKS), {"ignoreNullFields": "false"})
    out = flags.select("poll_id", research_ready(required).alias("valid"), count("error").cast("long").alias("error_count"), count("warning").cast("long").alias("warning_count"), *CHECKS, details.alias("details"))
    return out if validated_at is None else out.withColumn("validated_at", validated_at)


def upsert_validations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new take the place of those of old of the same poll."""
    return old.join(new.select("poll_id"), "poll_id", "left_anti").unionByName(new)


def summary(rows: DataFrame, *more: Column) -> DataFrame:
    """Totals, and further aggregates in the same pass."""
    return rows.agg(*more, F.count("*").alias("total"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"), F.count_if(F.col("warning_count") > 0).alias("with_warning"))


def check_report(rows: DataFrame) -> DataFrame:
    """Passed, failed and the share that passed (four decimals, 0 without rows) by check, in check order."""
    long = rows.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("ok")) for c in CHECKS])).alias("position", "x"))
    out = long.groupBy("position", F.col("x.name").alias("check_name")).agg(F.count_if("x.ok").alias("passed"), F.count_if(~F.col("x.ok")).alias("failed"))
    return out.withColumn("pass_share", share(F.col("passed"), F.col("passed") + F.col("failed")))


def share(part: Column, of: Column) -> Column:
    """A share with four decimals, 0 of nothing."""
    return F.coalesce(F.round(F.try_divide(part, of), 4), F.lit(0.0))


def top_failing(report: DataFrame, n: int) -> DataFrame:
    """The n checks that fail most, ties in check order."""
    rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("failed"), "position"))
    return report.filter("failed > 0").withColumn("rank", rank).filter(F.col("rank") <= n).select("rank", "check_name", "failed")


#: Public wording of a status.
PUBLIC_STATUS = {"pass": "ready", "warn": "review_recommended", "fail": "attention_needed"}


def quality_status(rows: DataFrame, max_invalid: float = 0.05, min_valid: float = 0.9, max_warning: float = 0.1) -> DataFrame:
    """Totals and shares with the status (pass, warn or fail), its public wording, and the latest validation where rows have validated_at."""
    latest = F.max("validated_at") if "validated_at" in rows.columns else F.max(F.lit(None).cast("timestamp"))
    s = summary(rows, latest.alias("latest_validated_at"))
    for name in ("valid", "invalid", "with_warning"):
        s = s.withColumn(f"{name}_share", share(F.col(name), F.col("total")))
    status = F.when(F.col("total") == 0, "warn").when(F.col("invalid_share") > max_invalid, "fail").when((F.col("valid_share") < min_valid) | (F.col("with_warning_share") > max_warning), "warn").otherwise("pass")
    public = F.create_map(*[F.lit(x) for kv in PUBLIC_STATUS.items() for x in kv])
    return s.withColumn("status", status).withColumn("public_status", F.element_at(public, F.col("status")))


def flagged(rows: DataFrame, n: int) -> DataFrame:
    """The first n polls that are invalid or jump."""
    return rows.filter(~F.col("valid") | ~F.col("qc_jump_institute") | ~F.col("qc_jump_scope")).orderBy("poll_id").limit(n).select("poll_id", "valid")
