"""Cleaning of raw rows: party results with diagnostics, rejection, fallbacks, statistics (C18, D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import survey as S


def explode_parties(rows: DataFrame, id_col: str = "id", column: str = "parties") -> DataFrame:
    """(id, pos, label, party, percentage, outcome) of a JSON object of labels and texts.

    A row without a payload, or whose payload is no object, gives one row with a null label.
    Labels that stand for no party are ``skipped``.  Of labels of the same party all but the
    first are a ``duplicate party``, with their value.
    """
    text = F.trim(F.col(column))
    parsed = rows.select(F.col(id_col).alias("id"), text.alias("text"), F.from_json(text, "map<string,string>").alias("m"))
    long = parsed.select("id", F.when(F.coalesce("text", F.lit("")) == "", "empty payload").when(F.col("m").isNull(), "no JSON object").alias("broken"), F.posexplode_outer(F.map_entries("m")).alias("pos", "e"))
    long = long.filter("broken is not null or e is not null").select("id", "pos", "broken", F.col("e.key").alias("label"), S.party(F.col("e.key")).alias("party"), S.percentage(F.col("e.value")).alias("percentage"))
    own = F.col("party").isNotNull() & F.col("percentage").isNotNull() & ~S.is_non_result(F.col("label"))
    # A partition is one party of one row.
    place = F.row_number().over(W.partitionBy("id", F.when(own, F.col("party")), ~F.coalesce(own, F.lit(False))).orderBy("pos"))
    outcome = (
        F.when(F.col("broken").isNotNull(), F.col("broken")).when(S.is_non_result(F.col("label")), "skipped").when(F.col("party").isNull(), "unknown party")
        .when(F.col("percentage").isNull(), "unparseable value").when(F.col("place") > 1, "duplicate party").otherwise("ok")
    )
    used = F.col("outcome").isin("ok", "duplicate party")
    return long.withColumn("place", place).withColumn("outcome", outcome).select("id", "pos", "label", F.when(used, F.col("party")).alias("party"), F.when(used, F.col("percentage")).alias("percentage"), "outcome")


def party_results(exploded: DataFrame) -> DataFrame:
    """(id, results map, n_failed, complete) by row: of a party's values the last counts; complete rows have results and nothing that failed."""
    values = exploded.filter("party is not null").groupBy("id", "party").agg(F.max_by("percentage", "pos").alias("percentage"))
    maps = values.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("party", "percentage")))).alias("results"))
    failed = exploded.groupBy("id").agg(F.count_if(~F.col("outcome").isin("ok", "skipped")).alias("n_failed"))
    return failed.join(maps, "id", "left").withColumn("complete", F.col("results").isNotNull() & (F.col("n_failed") == 0))


def results_of(payload: Column) -> Column:
    """C18 in one row: the results of a JSON object of labels and texts as a sorted array of (party, percentage), of a party's values the last; empty if there are none."""
    # A text without a brace is no object; the parser would throw for it.
    read = F.when(payload.contains("{"), F.from_json(F.trim(payload), "map<string,string>"))
    entries = F.transform(F.map_entries(read), lambda e: S.party_result(e["key"], e["value"]))
    own = F.filter(entries, lambda e: e["party"].isNotNull() & e["percentage"].isNotNull() & ~e["other"])
    # What a lambda takes from outside is evaluated for each of its elements, so the payload must not be read in there.
    last = S.once(own, lambda all: F.filter(all, lambda e, i: ~F.exists(F.slice(all, i + 2, F.size(all)), lambda x: x["party"] == e["party"])))
    return F.coalesce(F.array_sort(F.transform(last, lambda e: F.struct(e["party"].alias("party"), e["percentage"].alias("percentage")))), F.array().cast("array<struct<party:string,percentage:double>>"))


def rejection() -> Column:
    """Why a cleaned row (publish_date, ignore, results) is no poll, the first reason that holds; null if none does."""
    return F.when(F.col("publish_date").isNull(), "missing publish date").when(F.col("ignore"), "ignored timeframe").when(F.coalesce(F.size("results"), F.lit(0)) <= 0, "no party result")


def reject(rows: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Rows (id, publish_date, ignore, results map) with reason, the first that holds: null for those that stay. duplicates: (id, ...) of D5."""
    known = duplicates.select("id", F.lit(True).alias("__known")).distinct()
    return rows.join(known, "id", "left").withColumn("reason", rejection().when(F.col("__known"), "duplicate")).drop("__known")


def with_fallbacks(rows: DataFrame) -> DataFrame:
    """D3: rows (publish_date, survey_start, survey_end, respondents_text, method_text, provider) with missing dates from the respondents text, method (the text's hint before the raw one) and provider ``Unknown``."""
    text = F.col("respondents_text")
    # Dates in the text are looked for where a date is missing and there is a text.
    missing = text.isNotNull() & (F.col("survey_start").isNull() | F.col("survey_end").isNull())
    inside = rows.withColumn("__inside", F.when(missing, S.embedded_range(text, F.col("publish_date"))))
    said = F.coalesce(text, "method_text").isNotNull()
    return inside.withColumns(
        {
            "survey_start": F.coalesce("survey_start", "__inside.start"), "survey_end": F.coalesce("survey_end", "__inside.end"),
            "method": F.when(said, S.method(F.coalesce(S.method_hint(text), "method_text"))).otherwise("UNBEKANNT"), "provider": F.coalesce(F.nullif(F.trim("provider"), F.lit("")), F.lit("Unknown")),
        }
    ).drop("__inside")


def cleaning_statistics(outcomes: DataFrame, links: DataFrame, selected: DataFrame) -> DataFrame:
    """One row of counters. outcomes: (id, reason, existed) of the processed rows; links: E8; selected: F1."""
    made = F.col("reason").isNull()
    counts = outcomes.agg(F.count("*").alias("processed"), F.count_if(made & ~F.col("existed")).alias("created"), F.count_if(made & F.col("existed")).alias("updated"), F.count_if(~made).alias("skipped"))
    matches = links.filter("side = 'primary'").agg(F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") == "multiple_matches").alias("ambiguous"))
    public = selected.agg(F.count_if("is_public").alias("public"), F.count_if(~F.col("is_public")).alias("excluded"))
    return counts.crossJoin(matches).crossJoin(public)
