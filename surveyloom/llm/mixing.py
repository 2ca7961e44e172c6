"""Mixing sources to target weights by pivotal dependent rounding of copy counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import WORD, stored, whole

#: Documents that one step of the reduction tree pairs in one array.
BLOCK = 128
#: Source tables of at most so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: float) -> DataFrame:
    """(source, source_size, n_docs, target): all words shared by weight, no target above max_repeat times its source.

    Sources by code point, null last, take the weights in turn.  Filling by weight until no
    target is above its limit has one solution, min(limit, level * weight): sorted by
    limit / weight, the level is set by the first source that stays below its limit.  The
    windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    one = F.lit(1)
    rank = F.row_number().over(W.partitionBy(one).orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("limit", F.col("source_size") * float(max_repeat))
    order = W.partitionBy(one).orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(one)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)["level"])
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return per.select("source", F.col("source_size").cast("long").alias("source_size"), "n_docs", target.alias("target"))


def _pair(state, x, seed: int):
    """One pivotal step between the open document of the state and x: words move from one to the other until one copy chance is 0 or 1."""
    cur = state["open"]
    up = F.least((1 - cur["p"]) * cur["size"], x["p"] * x["size"])  # words that cur can gain from x
    down = F.least(cur["p"] * cur["size"], (1 - x["p"]) * x["size"])  # words that x can gain from cur
    coin = F.pmod(F.xxhash64(cur["key"], x["key"], F.lit(seed)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    gain = coin * (up + down) < down
    full_cur, full_x = (1 - cur["p"]) * cur["size"] <= x["p"] * x["size"], (1 - x["p"]) * x["size"] <= cur["p"] * cur["size"]
    cur_p = F.when(gain, F.when(full_cur, 1.0).otherwise(cur["p"] + up / cur["size"])).otherwise(F.when(full_x, cur["p"] - down / cur["size"]).otherwise(0.0))
    x_p = F.when(gain, F.when(full_cur, x["p"] - up / x["size"]).otherwise(0.0)).otherwise(F.when(full_x, 1.0).otherwise(x["p"] + down / x["size"]))
    cur_p, x_p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), cur_p)), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x_p))
    cur_done = (gain & full_cur) | (~gain & ~full_x)

    def moved(d, p):
        return F.struct(d["doc_id"].alias("doc_id"), d["size"].alias("size"), d["base"].alias("base"), d["key"].alias("key"), p.alias("p"))

    a, b = moved(cur, cur_p), moved(x, x_p)
    return F.when(cur.isNull(), F.struct(x.alias("open"), state["done"].alias("done"))).otherwise(
        F.when(cur_done, F.struct(b.alias("open"), F.array_append(state["done"], a).alias("done"))).otherwise(F.struct(a.alias("open"), F.array_append(state["done"], b).alias("done")))
    )


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: float = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, copies, taken).

    Every document of a source is wanted target / source_size times; whole copies are given
    at once and the fraction is rounded by pivotal steps, which keep a source's words
    exactly: paired documents exchange expected words until one of them has 0 or 1 further
    copies.  A level of the reduction tree pairs blocks of BLOCK documents, in order of a
    hash of their ids, and passes on one open document a block; the last open one of a
    source is rounded by its chance, so a source misses its target by less than that
    document's words.  Each draw is a hash of ids and seed: reruns agree.

    Null text has size 0.  Documents without words keep one copy and take nothing.  A null
    source is a source.  Rows that repeat an id are separate documents; whole repeated rows
    share their draw order.  An empty table gives an empty result.
    """
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(whole(text_col), F.lit(WORD)).cast("long").alias("size"))
    sizes = stored(sizes, "mix-sizes")
    targets = stored(source_targets(sizes, weights, max_repeat), "mix-targets")
    n_sources, most = targets.agg(F.count("*"), F.max("n_docs")).first()
    named = targets.withColumnsRenamed({"source": "of"})
    joined = sizes.join(F.broadcast(named) if n_sources <= BROADCAST_SOURCES else named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    chance = F.col("target") / F.col("source_size")
    joined = joined.withColumn("base", F.when(F.col("size") == 0, 1).otherwise(F.floor(chance)).cast("long")).withColumn("p", F.when(F.col("size") == 0, 0.0).otherwise(chance - F.floor(chance)))
    settled = joined.filter("p = 0").select("source", "doc_id", "size", F.col("base").alias("copies"))

    open_docs = joined.filter("p > 0").select("source", F.struct("doc_id", "size", "base", F.xxhash64("doc_id", "size", F.lit(seed)).alias("key"), "p").alias("d"))
    done, level = [settled], 0
    count = most or 0
    while count > 1 or level == 0:
        spread = 1 if count <= BLOCK else -(-count * 2 // BLOCK)
        start = F.struct(F.lit(None).cast(open_docs.schema["d"].dataType).alias("open"), F.array().cast(f"array<{open_docs.schema['d'].dataType.simpleString()}>").alias("done"))
        folded = (
            open_docs.groupBy("source", F.pmod(F.xxhash64(F.col("d.key"), F.lit(level)), F.lit(spread)).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("d.key").alias("k"), "d"))).alias("ds"))
            .select("source", F.aggregate(F.transform("ds", lambda x: x["d"]), start, lambda s, x: _pair(s, x, seed)).alias("r"))
        )
        folded = stored(folded.select("source", "r.open", "r.done"), f"mix-level{level}")
        done.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.doc_id", "d.size", (F.col("d.base") + F.col("d.p").cast("long")).alias("copies")))
        open_docs = folded.filter("open is not null").select("source", F.col("open").alias("d"))
        count, level = (spread if spread > 1 else 0), level + 1
    last = F.pmod(F.xxhash64(F.col("d.key"), F.lit(seed + 1)), F.lit(1 << 52)).cast("double") / float(1 << 52) < F.col("d.p")
    done.append(open_docs.select("source", "d.doc_id", "d.size", (F.col("d.base") + last.cast("long")).alias("copies")))
    rows = done[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    return rows.join(F.broadcast(named) if n_sources <= BROADCAST_SOURCES else named, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def apply_mix(docs: DataFrame, **kwargs) -> DataFrame:
    """The rows of docs, all columns, each repeated as often as the mix takes it.

    Copies are drawn and joined by row, not by id: rows without id, or that repeat one, take
    their own.  Rows that are equal in all columns are one row with the copies of all.
    """
    id_col, text_col = kwargs.pop("id_col", "doc_id"), kwargs.get("text_col", "text")
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    key = F.struct(F.col(id_col).alias("id"), F.unhex(F.md5(whole(text_col))).alias("digest"), F.xxhash64(F.col(text_col).isNull(), *others).alias("others"))
    keyed = docs.withColumn("__row", key)
    copies = mix_sources(keyed, id_col="__row", **kwargs).groupBy(F.col("doc_id").alias("__id")).agg(F.sum("copies").alias("__copies"), F.count("*").alias("__n"))
    copies = stored(copies.filter("__copies > 0"), "mix-copies")
    if not copies.filter("__n > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__row"])
    return keyed.join(copies, F.col("__row") == F.col("__id")).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
