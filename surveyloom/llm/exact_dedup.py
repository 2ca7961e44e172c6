"""Exact deduplication: 128-bit content hash, smallest id kept, bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, join_groups, partitions, stored, whole

#: A keeper's text is sent once for each so many members of its group, so no task compares a whole hot group.
MEMBERS_PER_SALT = 1000


def normalised(text: str):
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(whole(text), SPACE, " ")


def _md5(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = _md5) -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Rows are grouped by a 128-bit digest of their normalised text (MD5) and its length; the
    smallest id of a group stays.  Members' bytes are then compared with their keeper's, and
    rows that differ in spite of equal hashes are grouped again by the text itself.

    Null text is an empty text.  Rows without id are grouped too (an id is preferred as
    keeper; keep_id is null only if the whole group lacks ids); they are known by digest and
    length alone, as their bytes are not compared.  Rows that repeat an id and a
    text are all returned, each counted in group_size.  An empty table gives an empty result.
    Other columns of the input are ignored, whatever their names.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    # Texts are hashed once; all that follows but the comparison of bytes reads this table.
    hashed = texts.select("doc_id", digest(F.col("norm")).alias("digest"), F.octet_length("norm").alias("n_bytes"), F.sha2("norm", 256).alias("text_sha256"))
    hashed = stored(hashed, "hashed")
    groups = hashed.groupBy("digest", "n_bytes").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    groups = stored(groups, "groups")
    rows = join_groups(hashed, groups, ["digest", "n_bytes"], "group_size", hashed.count(), "left")
    # Stored, as it is read for members and for keepers: its plan in each of them is more than the driver should hold.
    grouped = stored(rows.filter("group_size > 1").select("doc_id", "digest", "keep_id", "group_size"), "grouped")
    odd = stored(_collisions(grouped, texts, digest, partitions(docs)), "collisions")
    rows = rows.withColumns({"keep_id": F.coalesce("keep_id", "doc_id"), "group_size": F.coalesce("group_size", F.lit(1)).cast("long")})
    if not odd.isEmpty():
        # No pair of texts with equal MD5 and length is expected; where one occurs its rows are grouped by their bytes.
        odd_groups = odd.groupBy("digest", "norm").agg(F.min("doc_id").alias("own_keep"), F.count("*").alias("own_size"))
        # By id and text: a row that shares its id with an odd one, but not its text, is none itself.
        odd_rows = odd.join(odd_groups, ["digest", "norm"]).select("doc_id", F.sha2("norm", 256).alias("text_sha256"), "own_keep", "own_size").distinct()
        lost = odd.groupBy("digest", F.octet_length("norm").alias("n_bytes")).agg(F.count("*").alias("lost"))
        rows = rows.join(odd_rows, ["doc_id", "text_sha256"], "left").join(lost, ["digest", "n_bytes"], "left")
        rows = rows.withColumns({"keep_id": F.coalesce("own_keep", "keep_id"), "group_size": F.coalesce("own_size", F.col("group_size") - F.coalesce("lost", F.lit(0)))})
    return rows.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")


def _collisions(rows: DataFrame, texts: DataFrame, digest: Callable[[Column], Column], n: int) -> DataFrame:
    """(doc_id, digest, norm) of the rows whose bytes differ from their keeper's. rows: those of groups of two or more."""
    members = rows.filter(F.col("doc_id") != F.col("keep_id")).select("doc_id", "digest", "keep_id", F.ceil(F.col("group_size") / MEMBERS_PER_SALT).alias("salts"))
    keepers = stored(members.groupBy("keep_id", "digest").agg(F.max("salts").alias("salts")).withColumnRenamed("keep_id", "doc_id"), "keepers")
    # Only the texts of groups are moved.
    chosen = stored(members.select("doc_id").unionByName(keepers.select("doc_id")), "chosen")
    dealt = texts.join(chosen, "doc_id", "left_semi").repartition(n, "doc_id")
    # Of rows that share an id only those with the member's text; as a condition, not a key, so that no text is hashed that joins nothing.
    left = dealt.join(members, "doc_id").filter(F.when(digest(F.col("norm")) == F.col("digest"), True).otherwise(False)).select("doc_id", "digest", "keep_id", "norm", F.pmod(F.xxhash64("doc_id"), "salts").alias("salt"))
    right = dealt.join(keepers, "doc_id").select(F.col("doc_id").alias("keep_id"), "digest", F.col("norm").alias("keeper"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    right = right.filter(F.when(digest(F.col("keeper")) == F.col("digest"), True).otherwise(False))
    same = F.col("norm") == F.col("keeper")
    # A keeper id may stand on several rows; a member is odd when none of them has its bytes.
    return left.join(right, ["keep_id", "digest", "salt"]).groupBy("doc_id", "digest", "norm").agg(F.max(same).alias("same")).filter(~F.col("same")).select("doc_id", "digest", "norm")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that stay: one per distinct normalised text (of rows that repeat id and text, one)."""
    sha = F.sha2(normalised(text_col), 256)
    # By id and text: an id on several texts stays with those of which it is the keeper.
    keep = exact_groups(docs, id_col, text_col).filter("kept and doc_id is not null").select(F.col("doc_id").alias("__keep"), F.col("text_sha256").alias("__kept_sha")).distinct()
    keep = stored(keep, "keep")
    known = docs.filter(F.col(id_col).isNotNull()).withColumn("__sha", sha)
    known = known.join(keep, (F.col(id_col) == F.col("__keep")) & (F.col("__sha") == F.col("__kept_sha")), "left_semi").dropDuplicates([id_col, "__sha"]).select(*docs.columns)
    without_id = docs.filter(F.col(id_col).isNull())
    if without_id.isEmpty():
        return known
    unknown = without_id.withColumn("__sha", sha).dropDuplicates(["__sha"])
    unknown = unknown.join(docs.filter(F.col(id_col).isNotNull()).select(sha.alias("__sha")).distinct(), "__sha", "left_anti")
    return known.unionByName(unknown.select(*docs.columns))
