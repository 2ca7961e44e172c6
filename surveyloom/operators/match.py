"""Linking equal records of two providers (E)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import stored


@dataclass(frozen=True)
class MatchConfig:
    """Defaults of the linking rules."""

    window_days: int = 7
    parties: tuple[str, ...] = ("SPD", "AFD")
    max_party_delta: float = 1.0
    max_total_delta: float = 1.5
    date_tolerance: int = 0
    respondent_tolerance: int = 0
    min_gap: float = 0.01


def side(polls: DataFrame, results: DataFrame, provider: str, cfg: MatchConfig) -> DataFrame:
    """The provider's dated polls (case-insensitive; with id, publish_date, scope, institute, election, respondents, survey_start and survey_end), links reset, with a column for each key party."""
    wide = results.filter(F.col("party").isin(*cfg.parties)).groupBy("poll_id").agg(*[F.max(F.when(F.col("party") == p, F.col("percentage"))).alias(f"p{i}") for i, p in enumerate(cfg.parties)])
    rows = polls.filter((F.lower("provider") == provider.lower()) & F.col("publish_date").isNotNull())
    complete = F.lit(True)
    for i in range(len(cfg.parties)):
        complete = complete & F.col(f"p{i}").isNotNull()
    return rows.join(wide, rows["id"] == wide["poll_id"], "left").drop("poll_id").withColumn("complete", complete)


def candidates(primary: DataFrame, secondary: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Pairs of the same scope and institute (null equals null), of the same election or one without any, near in time, near in all key parties; with score.

    The interval becomes an equi-join: days are cut into spans of the window's length and a
    primary looks in its own span and both neighbours, so one large scope and institute is
    still dealt out over its days.
    """
    span = cfg.window_days + 1
    day = F.datediff("publish_date", F.lit("1970-01-01"))
    p = primary.filter("complete").select(*[F.col(c).alias(f"a_{c}") for c in primary.columns], F.explode(F.array(*[(F.floor(day / span) + i) for i in (-1, 0, 1)])).alias("a_span"))
    s = secondary.filter("complete").select(*[F.col(c).alias(f"b_{c}") for c in secondary.columns], F.floor(day / span).alias("b_span"))
    near = F.abs(F.datediff("a_publish_date", "b_publish_date"))
    one, other = (F.coalesce(f"{side}_election", F.lit("")) for side in ("a", "b"))
    same_election = (one == other) | (one == "") | (other == "")
    pairs = p.join(s, (F.col("a_span") == F.col("b_span")) & F.col("a_scope").eqNullSafe(F.col("b_scope")) & F.col("a_institute").eqNullSafe(F.col("b_institute"))).filter((near <= cfg.window_days) & same_election)
    deltas = [F.abs(F.col(f"a_p{i}") - F.col(f"b_p{i}")) for i in range(len(cfg.parties))]
    total = sum(deltas[1:], deltas[0])
    worst = F.greatest(*deltas) if len(deltas) > 1 else deltas[0]
    pairs = pairs.withColumn("total", total).filter((worst <= cfg.max_party_delta) & (F.col("total") <= cfg.max_total_delta))
    return pairs.withColumn("score", F.col("total") + F.lit(0.1) * near)


def _evidence(pairs: DataFrame, known: Column, other_known: Column, agrees: Column) -> DataFrame:
    by = W.partitionBy("a_id")
    strict = F.max(F.when(known & other_known, 1).otherwise(0)).over(by)
    return pairs.withColumn("__strict", strict).filter((F.col("__strict") == 0) | F.coalesce(agrees, F.lit(False))).drop("__strict")


def with_evidence(pairs: DataFrame, cfg: MatchConfig) -> DataFrame:
    """E4, then E5: where the primary and any of its candidates have survey dates (respondents), only candidates that agree on them stay."""
    apart = lambda c: F.abs(F.datediff(f"a_{c}", f"b_{c}"))
    both = lambda s: F.col(f"{s}_survey_start").isNotNull() & F.col(f"{s}_survey_end").isNotNull()
    dated = _evidence(pairs, both("a"), both("b"), (apart("survey_start") <= cfg.date_tolerance) & (apart("survey_end") <= cfg.date_tolerance))
    return _evidence(dated, F.col("a_respondents").isNotNull(), F.col("b_respondents").isNotNull(), F.abs(F.col("a_respondents") - F.col("b_respondents")) <= cfg.respondent_tolerance)


def choose(pairs: DataFrame, cfg: MatchConfig) -> DataFrame:
    """All remaining pairs with rank and chosen: the best alone or by the least gap, and no secondary chosen twice."""
    by = W.partitionBy("a_id").orderBy("score", "b_id")
    ranked = pairs.withColumn("rank", F.row_number().over(by)).withColumn("gap", F.lead("score").over(by) - F.col("score"))
    best = (F.col("rank") == 1) & (F.col("gap").isNull() | (F.col("gap") >= cfg.min_gap))
    ranked = ranked.withColumn("best", best)
    taken = F.sum(F.when(F.col("best"), 1).otherwise(0)).over(W.partitionBy("b_id"))
    return ranked.withColumn("collision", F.col("best") & (taken > 1)).withColumn("chosen", F.col("best") & (taken == 1))


def link(primary: DataFrame, secondary: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id, side, status, matched_id) of both sides; a secondary in any ambiguous set has no link."""
    ambiguous = W.partitionBy("a_id")
    marked = chosen.withColumn("settled", F.max(F.when(F.col("chosen"), 1).otherwise(0)).over(ambiguous) == 1)
    of_a = marked.groupBy("a_id").agg(F.max(F.when(F.col("chosen"), F.col("b_id"))).alias("matched_id"))
    of_b = marked.groupBy("b_id").agg(F.max(F.when(F.col("chosen"), F.col("a_id"))).alias("matched_id"), F.max(~F.col("settled")).alias("ambiguous"))
    a = primary.join(of_a, primary["id"] == of_a["a_id"], "left")
    a = a.select("id", F.lit("primary").alias("side"), F.when(~F.col("complete"), "missing_results").when(F.col("a_id").isNull(), "no_match").when(F.col("matched_id").isNull(), "multiple_matches").otherwise("matched").alias("status"), "matched_id")
    b = secondary.join(of_b, secondary["id"] == of_b["b_id"], "left")
    status = F.when(~F.col("complete"), "missing_results").when(F.col("ambiguous"), "multiple_matches").when(F.col("matched_id").isNotNull(), "matched").otherwise("no_match")
    return a.unionByName(b.select("id", F.lit("secondary").alias("side"), status.alias("status"), F.when(status == "matched", F.col("matched_id")).alias("matched_id")))


def link_all(polls: DataFrame, results: DataFrame, cfg: MatchConfig, primary: str, secondary: str) -> DataFrame:
    """The links of all polls. Sides and pairs, which several parts of the links need, are made once."""
    a, b = (stored(side(polls, results, name, cfg), "side") for name in (primary, secondary))
    return link(a, b, stored(choose(with_evidence(candidates(a, b, cfg), cfg), cfg), "pairs"))


def reach(cfg: MatchConfig) -> int:
    """Days from a change within which relink() gives links anew: the rest of its span and one more."""
    return 8 * (cfg.window_days + 1)


def relink(polls: DataFrame, results: DataFrame, changed: DataFrame, cfg: MatchConfig, primary: str, secondary: str) -> tuple[DataFrame, DataFrame]:
    """E1 to E8 where polls have changed: (the links (id, side, status, matched_id) of the polls near a change, those polls).

    changed: (scope, institute, publish_date) of polls before and after their change, new and
    vanished ones too.  A change reaches as far as four windows: over a primary's candidates to
    the other primaries that chose one of them, and over all of theirs to secondaries that are in
    an ambiguous set.  So days are cut into spans of four windows; polls in the spans of changes
    and beside them are relinked, from polls up to two spans further, where what they depend on
    lies.  All other links stay what they are.
    """
    days = 4 * (cfg.window_days + 1)
    span = F.floor(F.datediff("publish_date", F.lit("1970-01-01")) / days)
    touched = changed.filter("publish_date is not null").select("scope", "institute", span.alias("span")).distinct()

    def within(reach: int) -> DataFrame:
        cells = touched.select(F.col("scope").alias("__scope"), F.col("institute").alias("__institute"), F.explode(F.array(*[F.col("span") + i for i in range(-reach, reach + 1)])).alias("__span")).distinct()
        return polls.join(cells, F.col("scope").eqNullSafe(F.col("__scope")) & F.col("institute").eqNullSafe(F.col("__institute")) & (span == F.col("__span")), "left_semi")

    near, around = within(1), within(3)
    return link_all(around, results, cfg, primary, secondary).join(near.select("id"), "id", "left_semi"), near


def match_statistics(links: DataFrame) -> DataFrame:
    """Counts; multiple_matches counts primaries, the others as the statuses stand on both sides (matched: primaries)."""
    one = lambda s, sides: F.count_if((F.col("status") == s) & F.col("side").isin(*sides))
    return links.agg(one("matched", ["primary"]).alias("matched"), one("no_match", ["primary", "secondary"]).alias("no_match"), one("multiple_matches", ["primary"]).alias("multiple_matches"), one("missing_results", ["primary", "secondary"]).alias("missing_results"))
