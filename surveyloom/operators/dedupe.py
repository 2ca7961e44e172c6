"""Duplicate rejection, first-wins rules and table replacement (B, D)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .joins import dense_numbers


def key_digest(keys: list[str]) -> Column:
    """128 bits of the keys' values, nulls among them; what a history keeps beside its rows so that reject_known() reads no more of it."""
    return F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))


def reject_known(new: DataFrame, known: DataFrame, keys: list[str], digest: str | None = None, made: Callable[[list[str]], Column] = key_digest) -> DataFrame:
    """B1: rows of new that no row of known equals on all keys, nulls equal.

    Of the history only ``digest``, its column of key digests, meets the batch (without one it is
    computed); a small batch is broadcast, so the history isn't shuffled.  Rows that share a
    digest with the batch are then compared on all keys, so equal digests of unlike rows do no harm.
    """
    marked = new.withColumn("__digest", made(keys))
    batch = marked.select("__digest").distinct()
    old = known.withColumn("__digest", F.col(digest) if digest else made(keys))
    hits = old.select("__digest").join(batch, "__digest", "left_semi").distinct()
    alike = old.join(hits, "__digest", "left_semi").select("__digest", *[F.col(c).alias(f"__{c}") for c in keys])
    same = marked["__digest"] == alike["__digest"]
    for c in keys:
        same = same & marked[c].eqNullSafe(alike[f"__{c}"])
    return marked.join(alike, same, "left_anti").drop("__digest")


def first_in_batch(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """B2: of rows equal on the keys, the first by order."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).filter("__n = 1").drop("__n")


def ingest_counts(parsed: DataFrame, inserted: DataFrame, by: str) -> DataFrame:
    """Parsed, inserted and skipped rows by source; rows without one are a source too."""
    p = parsed.groupBy(by).agg(F.count("*").alias("parsed"))
    i = inserted.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("inserted"))
    n = F.coalesce("inserted", F.lit(0)).cast("long")
    return p.join(i, F.col(by).eqNullSafe(F.col("__by")), "left").select(by, "parsed", n.alias("inserted"), (F.col("parsed") - n).alias("skipped"))


def silent_sources(run_counts: DataFrame, history: DataFrame, by: str) -> DataFrame:
    """Sources without rows in this run that have earlier ones."""
    return run_counts.filter("n = 0").join(history.select(by), by, "left_semi").select(by)


def fingerprint(poll_fields: dict[str, Column], results: Column) -> Column:
    """SHA-256 of the JSON of all fields by name, nulls included, and the results by party in thousandths; null without results. JSON escapes what separates values, so different polls have different texts."""
    parts = F.transform(F.array_sort(results), lambda r: F.struct(r["party"].alias("party"), F.round(r["percentage"] * 1000).cast("long").alias("value")))
    fields = [poll_fields[name].alias(name) for name in sorted(poll_fields)]
    return F.when(F.size(results) > 0, F.sha2(F.to_json(F.struct(*fields, parts.alias("results")), {"ignoreNullFields": "false"}), 256))


def unprocessed(raw: DataFrame, polls: DataFrame, duplicates: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw rows without a cleaned poll that are no known duplicates, in id order."""
    out = _without(raw, polls, duplicates).orderBy("id")
    return out.limit(limit) if limit is not None else out


def _without(raw: DataFrame, polls: DataFrame, duplicates: DataFrame) -> DataFrame:
    return raw.join(polls.select(F.col("raw_id").alias("id")), "id", "left_anti").join(duplicates.select("id"), "id", "left_anti")


MODES = ("incremental", "reprocess", "rebuild")


def select_run(raw: DataFrame, polls: DataFrame, duplicates: DataFrame, mode: str = "incremental", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw rows that a run reads, polls that it starts from).

    incremental: the unprocessed rows (D1); reprocess: all rows; rebuild: all rows, and no
    poll of before.  No limit, or a limit of 0, is all rows, in any order: to sort them would
    read the raw rows twice.  Another mode is a ValueError.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {', '.join(MODES)}")
    if mode == "incremental":
        return (unprocessed(raw, polls, duplicates, limit) if limit else _without(raw, polls, duplicates)), polls
    return (raw.orderBy("id").limit(limit) if limit else raw), (polls.filter(F.lit(False)) if mode == "rebuild" else polls)


def finish_run(polls: DataFrame, version: str, dry_run: bool = False) -> int:
    """Write the polls of a run to the folder of a new version, or with dry_run to nowhere; returns their number.  A version that exists is an error."""
    if dry_run:
        return polls.count()
    polls.write.mode("error").parquet(version)
    return polls.sparkSession.read.schema(polls.schema).parquet(version).count()


def first_by_fingerprint(rows: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, duplicates(id, duplicate_of)): a stored fingerprint wins, then the smallest id of the batch.  A row without fingerprint (a poll without results) is no duplicate."""
    s = stored.filter("fingerprint is not null").groupBy("fingerprint").agg(F.min("id").alias("stored_id"))
    known = rows.filter("fingerprint is not null")
    first = known.groupBy("fingerprint").agg(F.min("id").alias("first_id"))
    marked = known.join(first, "fingerprint").join(s, "fingerprint", "left").withColumn("duplicate_of", F.coalesce("stored_id", F.when(F.col("first_id") != F.col("id"), F.col("first_id"))))
    kept = marked.filter("duplicate_of is null").select(*rows.columns).unionByName(rows.filter("fingerprint is null"))
    return kept, marked.filter("duplicate_of is not null").select("id", "duplicate_of")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new replace those of old with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def sync_children(old: DataFrame, new: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """The child rows of touched parents become those of new; vanished ones go."""
    return old.join(touched.select(key).distinct(), key, "left_anti").unionByName(new)


def backfill(polls: DataFrame, computed: DataFrame) -> DataFrame:
    """Missing fingerprints filled in id order, never to one that another poll has."""
    used = polls.filter("fingerprint is not null").select(F.col("fingerprint").alias("used"))
    open_rows = polls.filter("fingerprint is null").select("id").join(computed.select("id", F.col("fingerprint").alias("made")), "id")
    first = open_rows.withColumn("n", F.row_number().over(W.partitionBy("made").orderBy("id"))).filter("n = 1").join(used, F.col("made") == F.col("used"), "left_anti")
    return polls.join(first.select("id", "made"), "id", "left").withColumn("fingerprint", F.coalesce("fingerprint", "made")).drop("made")


def new_members(rows: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """The dimension with members for unseen names, ids going on without gaps in the order of names; they are numbered by ranges, so there may be any number of them."""
    top = dim.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    unseen = rows.select(name).filter(F.col(name).isNotNull()).distinct().join(dim.select(name), name, "left_anti")
    numbered = dense_numbers(unseen, [name]).crossJoin(F.broadcast(top))
    return dim.select("id", name).unionByName(numbered.select((F.col("top") + F.col("n")).cast("long").alias("id"), name))
