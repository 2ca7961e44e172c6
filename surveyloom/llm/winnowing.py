"""Document fingerprints by winnowing, in native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import buckets, stored, whole

#: Bits of a gram value below its hash: its place counted from the end of any text that Spark can hold, so the least value of a window is the least hash and, among equal ones, the rightmost.
PLACE_BITS = 31
LAST_PLACE = (1 << PLACE_BITS) - 1
HASH_BITS = 32
#: Windows that are evaluated at a time, so that a very long text needs no array of its length.
SEGMENT = 1 << 16
#: Quantiles of the ids that the driver gets, and ranges of ids into which documents are dealt out at most; the table of ranges (a few bytes each) is broadcast.
QUANTILES, RANGES = 1000, 200_000


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _grams(data: Column, k: int) -> Column:
    """One long per k-byte gram of the binary (one for the whole of a shorter one): the hash above, the complement of the gram's place in the binary, counted from 1, below."""

    def packed(i: Column) -> Column:
        hashed = F.xxhash64(F.substring(data, i, F.lit(k)))
        return F.shiftrightunsigned(hashed, 1).bitwiseOR(F.lit(LAST_PLACE)) - i

    return F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(data) - (k - 1), F.lit(1))), packed)


def _least(values: Column, window: int) -> Column:
    """The least of each ``window`` consecutive values (of all, if they are fewer)."""

    def of(vs: Column) -> Column:
        out, width = vs, 1
        while width < window:  # beside each least of ``width`` values that of the next ones; behind the last there is nothing
            step = min(width, window - width)
            out, width = _let(out, lambda x: F.zip_with(x, F.slice(x, step + 1, F.size(x)), lambda a, b: F.least(a, b))), width + step
        return F.when(F.size(vs) <= window, F.array(F.array_min(vs))).otherwise(F.slice(out, F.lit(1), F.size(vs) - (window - 1)))

    return _let(values, of)


def _winnowed(data: Column, start: Column, k: int, window: int) -> Column:
    """Packed values of the winnowed grams of a binary, whose first byte is at place ``start``."""
    n_windows = F.greatest(F.octet_length(data) - (k + window - 2), F.lit(1))

    def segment(s: Column) -> Column:
        chosen = _let(F.substring(data, s + 1, F.lit(SEGMENT + k + window - 2)), lambda part: F.array_distinct(_least(_grams(part, k), window)))
        return F.transform(chosen, lambda x: x + 1 - start - s)

    starts = F.sequence(F.lit(0), n_windows - 1, F.lit(SEGMENT))
    return F.when(F.octet_length(data) == 0, F.array().cast("array<long>")).otherwise(F.array_distinct(F.flatten(F.transform(starts, segment))))


def _bytes(text: Column) -> Column:
    return F.encode(F.lower(text), "UTF-8")


def winnow(text: Column, k: int = 24, window: int = 16) -> Column:
    """Packed values of the winnowed grams in order of place; see unpack()."""
    return _let(_bytes(text), lambda data: _winnowed(data, F.lit(0), k, window))


def rewinnow(packed: Column, text: Column, edited: Column, kept: Column, k: int = 24, window: int = 16) -> Column:
    """winnow(edited), of which the first ``kept`` characters are those of text, from text's packed values.

    All windows that hold a gram end k + window - 1 bytes after it at most, so grams so far
    before the end of the kept bytes are chosen in both texts or in neither.  What follows is
    winnowed, from the first window on that can choose a later gram.
    """
    sides = F.struct(_bytes(edited).alias("data"), F.octet_length(_bytes(F.substring(text, F.lit(1), kept))).alias("n"), _bytes(text).alias("before"))

    def of(x: Column) -> Column:
        # Lower case can depend on what follows: only if the bytes are the same.
        same = F.substring(x["data"], F.lit(1), x["n"]) == F.substring(x["before"], F.lit(1), x["n"])
        settled = F.when(same, F.greatest(x["n"] - (k + window - 1), F.lit(-1))).otherwise(-1)

        def joined(last: Column) -> Column:
            start = F.greatest(last - (window - 2), F.lit(0))
            tail = _let(F.substring(x["data"], start + 1, F.octet_length(x["data"])), lambda data: _winnowed(data, start, k, window))
            return F.concat(F.filter(packed, lambda v: _place(v) <= last), F.filter(tail, lambda v: _place(v) > last))

        return _let(settled, joined)

    return _let(sides, of)


def _place(x: Column) -> Column:
    return F.lit(LAST_PLACE) - x.bitwiseAND(F.lit(LAST_PLACE))


def hashes(packed: Column) -> Column:
    """The distinct hashes of a winnowed fingerprint."""
    return F.array_distinct(F.transform(packed, lambda x: F.shiftright(x, PLACE_BITS)))


def unpack(packed: Column) -> Column:
    """array<struct<pos, hash>> in order of place."""
    return F.transform(packed, lambda x: F.struct(_place(x).alias("pos"), F.shiftright(x, PLACE_BITS).alias("hash")))


def as_text(packed: Column) -> Column:
    """place:hash pairs in hexadecimal, joined by commas."""
    return F.array_join(F.transform(packed, lambda x: F.concat(F.hex(_place(x)), F.lit(":"), F.hex(F.shiftright(x, PLACE_BITS)))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash arrays without repeats; two empty ones are alike (1), an empty and another are not (0)."""

    def of(x: Column) -> Column:
        return F.when(x["sizes"] == 0, 1.0).otherwise(x["both"] / (x["sizes"] - x["both"])).cast("double")

    sides = F.struct(a.alias("a"), b.alias("b"))
    return _let(_let(sides, lambda x: F.struct(F.size(F.array_intersect(x["a"], x["b"])).alias("both"), (F.size(x["a"]) + F.size(x["b"])).alias("sizes"))), of)


def fingerprints(docs: DataFrame, k: int = 24, window: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint array<struct<pos, hash>>) of every whole text.

    Grams are the k consecutive bytes at each place of the lower-cased text in UTF-8, in any
    script; the least gram of each ``window`` consecutive ones is kept, the rightmost of equal
    ones, with its place.  Two texts that share k + window - 1 bytes in a row share a
    fingerprint hash.  A text of fewer than k bytes is one gram; an empty or null text has an
    empty fingerprint.  Repeated rows each have one; an empty table gives an empty result.
    Other columns are ignored, whatever their names.
    """
    return docs.select(F.col(id_col).alias("doc_id"), unpack(winnow(whole(text_col), k, window)).alias("fingerprint"))


def _index(ids: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or below the id, by binary search."""
    if not bounds:
        return F.lit(0)
    array = F.lit(bounds).cast("array<long>")
    jumps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(jumps, F.lit(0), lambda at, jump: F.when((at + jump <= len(bounds)) & (F.try_element_at(array, F.least(at + jump, F.lit(len(bounds)))) <= ids), at + jump).otherwise(at))


def _range(n: int, lowest: int, highest: int, bounds: list[int]) -> Column:
    """Range of each row: quantile ranges of the ids, each cut evenly, about n in all and falling in the order of documents; rows without id are dealt out by ``tie`` below them."""
    cuts = -(-n // (len(bounds) + 1))

    def of(c: Column) -> Column:
        low, high = F.element_at(F.lit([lowest, *bounds]).cast("array<double>"), c + 1), F.element_at(F.lit([*bounds, highest]).cast("array<double>"), c + 1)
        within = F.least(F.lit(cuts - 1), F.floor((F.col("doc_id").cast("double") - low) / (high - low + 1) * cuts))
        return (c * cuts + within).cast("long")

    share = F.col("tie").cast("double") / 2.0**64 + 0.5
    return F.when(F.col("doc_id").isNotNull(), _let(_index(F.col("doc_id"), bounds), of)).otherwise(-1 - F.floor(share * n))


def with_next(docs: DataFrame, mb: float = 1.0) -> tuple[DataFrame, W]:
    """Rows (doc_id, text, bucket, copy) and the window in which the row after each is its next document.

    Next is by descending id, after the last the first.  Each range of ids also gets the first
    row of the range that follows, so no window spans more than its range.  A range has about
    ``mb`` MB, more where that would make more than RANGES of them; what the driver gets does
    not grow with the input.
    """
    n = min(buckets(docs, mb), RANGES)
    coarse = min(n, QUANTILES)
    some = [(i + 1) / coarse for i in range(coarse - 1)]
    stats = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count_if(F.col("doc_id").isNull()), F.percentile_approx("doc_id", some, 10 * QUANTILES) if some else F.lit(None)).first()
    lowest, highest, bounds = stats[0] or 0, stats[1] or 0, sorted(set(stats[3] or []))
    tie = F.xxhash64("text") if stats[2] else F.lit(0).cast("long")
    rows = docs.withColumn("tie", F.when(F.col("doc_id").isNull(), tie)).withColumn("bucket", _range(n, lowest, highest, bounds))
    # The first row of each range, and the range before, which it follows; before the first is the last.
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "tie")
    tops = stored(rows.groupBy("bucket").agg(F.min(key).alias("top")), "ranges")
    order = W.partitionBy(F.lit(1)).orderBy(F.desc("bucket"))
    last = W.partitionBy(F.lit(1))
    firsts = tops.select(F.coalesce(F.lag("bucket").over(order), F.min("bucket").over(last)).alias("to_bucket"), F.bitwise_not("top.down").alias("first_id"), F.col("top.tie").alias("first_tie"))
    led = rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("tie").eqNullSafe(F.col("first_tie")))
    # Of rows that share a leading id only the one that comes first is led in.
    led = led.groupBy("to_bucket").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text")).select("doc_id", "text", F.lit(None).cast("long").alias("tie"), F.col("to_bucket").alias("bucket"))
    out = rows.withColumn("copy", F.lit(False)).unionByName(led.withColumn("copy", F.lit(True)))
    return out, W.partitionBy("bucket").orderBy(F.col("copy").asc(), F.col("doc_id").desc_nulls_last(), F.col("tie").asc(), F.col("text").asc())


def edited_likeness(docs: DataFrame, k: int = 24, window: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and their likenesses.

    The edited text replaces the last third of the code points by the first as many (or all)
    of the next document by descending id.  Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint (place:hash text), near_edited, near_next.

    Null text is empty.  Null ids come after all others, in the order of a hash of their
    texts.  Of rows that share an id the order is by text; rows equal in both are each
    other's next.  A table of one row is its own next.  An empty table gives an empty result.
    Ids are cast to long; other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    rows, order = with_next(src)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    # Texts are moved first, fingerprints are made where they have arrived.
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("fp", winnow(F.col("text"), k, window)).withColumn("next_fp", F.lead("fp").over(order)).filter(~F.col("copy"))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next", F.lit(1), cut)))
    rows = rows.withColumn("edited_fp", rewinnow(F.col("fp"), F.col("text"), F.col("edited"), n - cut, k, window))
    # Hashes are taken from the packed values once for both likenesses.
    sets = F.struct(*[hashes(F.col(c)).alias(c) for c in ("fp", "edited_fp", "next_fp")])
    near = _let(sets, lambda x: F.struct(likeness(x["fp"], x["edited_fp"]).alias("near_edited"), likeness(x["fp"], x["next_fp"]).alias("near_next")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"), near.alias("near"),
    ).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near.near_edited", "near.near_next")
