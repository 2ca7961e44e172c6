"""Near-duplicate detection by an LSH forest over MinHash signatures.

A tree of the forest sorts all documents by its own order of signature values.  Documents
that share a prefix form a region; a region of many documents is divided at greater depth,
then dealt out in blocks, and in a block neighbours by longest common prefix are candidates,
as are the blocks' first documents among themselves.  What that leaves in different
components, but the signatures don't rule out, is compared in a second round, in which
members of one component don't meet again.  So a group of copies costs work in proportion to
its size, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import wordhash
from .common import join_groups, sliced, stored, whole
from .components import components

TREES = 24
#: Values of a tree's order that a region shares at least.  A pair at similarity 0.8 shares none of 24 such prefixes with a chance of 3e-8.
DEPTH = 3
#: Signature values: TREES * DEPTH for the forest, the rest only for estimates.
HASHES = 768
#: Documents of a region that are compared together; larger regions are cut into blocks.
BLOCK = 1024
#: Rows that one task compares at a time: many small regions, or a few blocks.
BUCKET = 4096
#: Pairs whose signatures are compared at a time.
PAIRS = 8192
#: Bytes of text that one task holds as numpy arrays at a time.
CHUNK = 1 << 19
#: Pairs of whole sets that are Python objects at a time.
CONFIRMED = 500

_FACTORS = np.random.Generator(np.random.PCG64(99)).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOREST = TREES * DEPTH


def estimate_floor(threshold: float) -> float:
    """The least share of equal signature values of a pair at the threshold, 4.5 standard errors below it."""
    return threshold - 4.5 * float(np.sqrt(threshold * (1 - threshold) / HASHES))


def _signatures(k: int):
    def run(batches):
        for batch in sliced(batches):
            ids, texts = batch.column(0).to_pylist(), [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for some, chunk in wordhash.chunks(ids, texts, CHUNK):
                yield _signed(some, chunk, k)

    return run


def _signed(ids, texts, k):
    sets, offsets = wordhash.shingle_sets(texts, k)
    n = np.diff(offsets)
    full = np.flatnonzero(n)
    values = np.zeros((len(ids), HASHES), dtype=np.uint32)
    digest = np.zeros((len(ids), 2), dtype=np.uint64)
    if len(full):
        at = offsets[:-1][full]
        for j in range(HASHES):
            values[full, j] = np.minimum.reduceat((sets ^ (sets >> np.uint64(31))) * _FACTORS[j], at) >> np.uint64(32)
        digest[full, 0] = np.add.reduceat(wordhash.mix(sets), at)
        digest[full, 1] = np.add.reduceat(wordhash.mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
    forest = values[:, :_FOREST]
    keys = np.zeros((len(ids), TREES), dtype=np.uint64)
    for d in range(DEPTH):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + forest[:, d::DEPTH].astype(np.uint64)
    keys = wordhash.mix(keys)
    deeper = np.stack([(np.roll(forest, -(t + 1) * DEPTH, axis=1)[:, 0].astype(np.uint64) << np.uint64(32)) | np.roll(forest, -(t + 1) * DEPTH, axis=1)[:, 1] for t in range(TREES)], axis=1)
    sketch = [forest[i].tobytes() + (values[i, _FOREST:] & np.uint32(255)).astype(np.uint8).tobytes() for i in range(len(ids))]
    lists = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(a).view(np.int64).ravel()), TREES).cast(pa.list_(pa.int64()))
    d64 = digest.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(d64[:, 0]), pa.array(d64[:, 1]), lists(keys), lists(deeper), pa.array(sketch, pa.binary())],
        names=["doc_id", "n_shingles", "digest_a", "digest_b", "keys", "deeper", "sketch"],
    )


def _opened(sketches: list[bytes]):
    raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    return np.ascontiguousarray(raw[:, : 4 * _FOREST]).view(np.uint32), raw[:, 4 * _FOREST :]


def _alike(size, forest, rest, i, j, threshold: float, floor: float):
    """Those of the pairs i, j that sizes and signatures do not rule out."""
    small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    ok = small >= threshold * large
    i, j = i[ok], j[ok]
    keep = np.zeros(len(i), dtype=bool)
    for a in range(0, len(i), PAIRS):
        x, y = i[a : a + PAIRS], j[a : a + PAIRS]
        keep[a : a + PAIRS] = (forest[x] == forest[y]).sum(axis=1) + (rest[x] == rest[y]).sum(axis=1) >= floor * HASHES
    return i[keep], j[keep]


def _pairs(ids, i, j) -> pa.Table:
    return pa.table({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})


def _neighbours(threshold: float, floor: float):
    """Candidates of blocks of regions: neighbours by longest common prefix, and each document with the first one that shares its prefix at the depth where at most 32 documents do."""

    def run(table: pa.Table) -> pa.Table:
        ids, size, tree, group = (table.column(c).to_numpy() for c in ("doc_id", "n_shingles", "tree", "group"))
        forest, rest = _opened(table.column("sketch").to_pylist())
        # The six values after those that the region shares, in the tree's order.
        after = np.take_along_axis(forest, ((tree[:, None] + 1) * DEPTH + np.arange(6)) % _FOREST, axis=1)
        order = np.lexsort((ids, *[after[:, c] for c in range(5, -1, -1)], group))
        after, group = after[order], group[order]
        prefix = np.cumprod(after[1:] == after[:-1], axis=1).sum(axis=1)
        prefix[group[1:] != group[:-1]] = -1
        start = np.zeros(len(order), dtype=np.int64)
        open_rows = np.ones(len(order), dtype=bool)
        for depth in range(7):
            new = np.concatenate([[True], prefix < depth])
            at = np.flatnonzero(new)
            part = np.cumsum(new) - 1
            here = open_rows & ((np.diff(np.append(at, len(order)))[part] <= 32) | (depth == 6))
            start[here] = at[part[here]]
            open_rows &= ~here
        near = prefix >= 0
        i, j = np.concatenate([order[:-1][near], order[start]]), np.concatenate([order[1:][near], order])
        apart = i != j
        return _pairs(ids, *_alike(size, forest, rest, i[apart], j[apart], threshold, floor))

    return run


def _strangers(threshold: float, floor: float):
    """Candidates among documents of different components that meet in a pair of blocks, or in one; a pair that several trees hold counts for the first."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("group").to_numpy(), kind="stable")
        ids, size, tree, group, comp, block, within = (table.column(c).to_numpy()[order] for c in ("doc_id", "n_shingles", "tree", "group", "component", "block", "within"))
        forest, rest = _opened([table.column("sketch")[int(k)].as_py() for k in order])
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, int(np.diff(np.append(edges, len(group))).max())):
            meet = (group[d:] == group[:-d]) & (comp[d:] != comp[:-d]) & (within[d:] | (block[d:] != block[:-d]))
            i = np.flatnonzero(meet)
            i, j = _alike(size, forest, rest, i, i + d, threshold, floor)
            if len(i):
                shared = (forest[i] == forest[j]).reshape(len(i), TREES, DEPTH).all(axis=2)
                first = shared.argmax(axis=1) == tree[i]
                found_i.append(i[first])
                found_j.append(j[first])
        return _pairs(ids, np.concatenate(found_i), np.concatenate(found_j))

    return run


def _compared(rows: DataFrame, sketches: DataFrame, n: int, by: list[str], run) -> DataFrame:
    """Pairs that ``run`` finds in the groups of rows, which come to a task with others of a bucket."""
    group = F.xxhash64(*by)
    rest = [c for c in ("component", "block", "within") if c in rows.columns]
    dealt = rows.select("doc_id", "tree", *rest, group.alias("group")).withColumn("bucket", F.pmod("group", F.lit(max(1, -(-n // BUCKET)))))
    return dealt.join(sketches, "doc_id").groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def _dealt(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows with ``sub``: groups of more than BLOCK rows are dealt out by hash in blocks of about BLOCK."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK)
    return join_groups(rows, sizes, keys, "size", total, "left").withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.ceil(F.coalesce("size", F.lit(1)) / BLOCK))).drop("size")


def _sets(k: int):
    def run(batches):
        for batch in sliced(batches):
            ids, texts = batch.column(0).to_pylist(), [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for some, chunk in wordhash.chunks(ids, texts, CHUNK):
                sets, offsets = wordhash.shingle_sets(chunk, k)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([sets[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(some))], pa.binary())], names=["doc_id", "shingles"])

    return run


def _verified(percent: int):
    def run(batches):
        for batch in sliced(batches, CONFIRMED):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _first_round(regions: DataFrame, sketches: DataFrame, n: int, threshold: float, floor: float) -> DataFrame:
    """Candidate pairs of neighbours.  A region of more than BLOCK documents is cut by its next values (greater depth), parts that are still large by hash; the first document of each block stands for it among those of its region, again in blocks."""
    columns = ["tree", "key", "level", "part", "sub", "doc_id"]
    cut = regions.withColumn("part", F.when(F.col("members") > BLOCK, F.col("deep")).otherwise(0)).withColumn("level", F.lit(0))
    cut = stored(_dealt(cut, ["tree", "key", "part"], n).select(*columns, "members"), "blocks")
    blocks = cut.select(*columns)
    heads = cut.filter(F.col("members") > BLOCK).groupBy("tree", "key", "part", "sub").agg(F.min("doc_id").alias("doc_id"))
    level = 1
    while True:
        heads = stored(heads.select("tree", "key", F.lit(level).alias("level"), F.lit(0).cast("long").alias("part"), "doc_id"), "heads")
        dealt = _dealt(heads, ["tree", "key"], n).select(*columns)
        blocks = blocks.unionByName(dealt)
        if dealt.filter("sub > 0").isEmpty():  # all heads of a region are in one block
            break
        heads = dealt.groupBy("tree", "key", "sub").agg(F.min("doc_id").alias("doc_id"))
        level += 1
    return _compared(blocks, sketches, n, ["tree", "key", "level", "part", "sub"], _neighbours(threshold, floor))


def _second_round(regions: DataFrame, of: DataFrame, sketches: DataFrame, n: int, threshold: float, floor: float) -> DataFrame:
    """Candidate pairs of regions that still hold different components.

    A component of more than BLOCK documents in a region has blocks of its own, which don't
    meet each other; the others share blocks, each component whole in one.
    """
    at, region = ["tree", "key", "component"], ["tree", "key"]
    labelled = stored(regions.join(of.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("tree", "key", "doc_id", "members", F.coalesce("component", "doc_id").alias("component")), "labelled")
    # Each part is stored: in one plan the parts would be repeated, and the driver holds that plan anew for each of its stages.
    per = stored(labelled.groupBy(*at).agg(F.count("*").alias("size")), "components-by-region")
    own = F.col("size") > BLOCK
    totals = per.groupBy(*region).agg(F.count("*").alias("n_components"), F.sum("size").alias("in_region"), F.sum(F.when(~own, F.col("size")).otherwise(0)).alias("in_small"), F.count_if(own).alias("n_large"))
    totals = stored(totals.filter("n_components > 1").drop("n_components"), "open-regions")
    rows = stored(join_groups(labelled, totals.select("tree", "key", "in_region", "in_small"), region, "in_region", n), "open-rows")
    rows = join_groups(rows, per.filter(own), at, "size", n, "left")

    def block(own: Column, number: Column) -> Column:
        return F.xxhash64(F.when(own, F.col("component")).otherwise(-1), number)

    number = F.when(F.col("size").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / BLOCK))).otherwise(F.pmod(F.xxhash64("component"), F.greatest(F.ceil(F.col("in_small") / BLOCK), F.lit(1))))
    rows = stored(rows.select("tree", "key", "doc_id", "component", block(F.col("size").isNotNull(), number).alias("block")), "rows-by-block")

    numbers = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / BLOCK) - 1))
    small = totals.filter("in_small > 0").select(*region, numbers("in_small").alias("number")).select(*region, F.xxhash64(F.lit(-1).cast("long"), "number").alias("block"))
    large = per.filter(own).join(totals.select(*region, "n_large"), region).select(*at, "n_large", numbers("size").alias("number"))
    large = stored(large.select(*at, "n_large", F.xxhash64("component", "number").alias("block")), "large-blocks")
    x, y = (small.select(*region, F.col("block").alias(c)) for c in ("lo", "hi"))
    meetings = x.join(y, region).filter("lo <= hi").unionByName(x.join(large.select(*region, F.col("block").alias("hi")), region))
    several = large.filter("n_large > 1")
    meetings = meetings.unionByName(several.select(*region, F.col("block").alias("lo"), F.col("component").alias("c")).join(several.select(*region, F.col("block").alias("hi"), "component"), region).filter("c < component").select(*region, "lo", "hi"))
    sides = stored(meetings.withColumn("block", F.explode(F.array_distinct(F.array("lo", "hi")))), "meetings")
    met = rows.join(sides, ["tree", "key", "block"]).withColumn("within", F.col("lo") == F.col("hi"))
    met = stored(met, "strangers")
    return _compared(met, sketches, met.count(), ["tree", "key", "lo", "hi"], _strangers(threshold, floor))


def _links(src: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id and n_shingles of every row, links (a, b) between rows). src: (doc_id long, text), each id at most once but null."""
    schema = "doc_id long, n_shingles long, digest_a long, digest_b long, keys array<long>, deeper array<long>, sketch binary"
    signed = stored(src.mapInArrow(_signatures(k), schema), "signatures")

    # Equal sets are one vertex from here on.
    whole_sets = signed.filter("doc_id is not null and n_shingles > 0")
    digest = ["digest_a", "digest_b", "n_shingles"]
    same = stored(whole_sets.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets-once")
    reps = whole_sets.select("doc_id", "keys", "deeper").join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    tree = reps.select("doc_id", F.posexplode(F.arrays_zip("keys", "deeper")).alias("tree", "x")).select("tree", F.col("x.keys").alias("key"), F.col("x.deeper").alias("deep"), "doc_id")
    shared = stored(tree.groupBy("tree", "key").agg(F.count("*").alias("members")).filter("members > 1"), "shared")
    # 24 rows a document pass one join, which is written as it is, so that Spark can split a region of very many documents.
    regions = stored(tree.join(shared, ["tree", "key"]), "regions")
    n = regions.count()
    sketches = signed.select("doc_id", "n_shingles", "sketch")
    threshold, floor = percent / 100, estimate_floor(percent / 100)

    pairs = stored(_first_round(regions, sketches, n, threshold, floor), "neighbours")
    # Only documents of regions can be in a pair: their sets are made once, for both rounds.
    sets = stored(src.join(regions.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_sets(k), "doc_id long, shingles binary"), "sets")
    links = stored(_confirm(pairs, sets, percent), "links")
    more = stored(_second_round(regions, components(links), sketches, n, threshold, floor).join(pairs, ["a", "b"], "left_anti"), "rest")
    twins = join_groups(whole_sets.select("doc_id", *digest), same.filter("copies > 1"), digest, "copies", signed.count()).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    more = stored(_confirm(more, sets, percent), "more-links")
    return signed.select("doc_id", "n_shingles"), links.unionByName(more).unionByName(stored(twins, "twins"))


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_shingles, component_id, kept).

    A document's set holds its distinct k-word shingles (A-Z lower-cased, ASCII white space
    between words), with fewer words its whole sequence.  Documents are linked if
    100 * intersection >= percent * union, confirmed on the whole sets.  component_id is the
    smallest id reachable over links.

    Null and wordless texts have an empty set and are linked with nothing.  Rows without id
    are not linked; they have a null component and are kept.  Rows that share an id are one
    document, linked if the set of any is.  An empty table gives an empty result.  Ids are
    cast to long.  Other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    if src.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        signed, links = _links(src, k, percent)
        of = components(links)
        out = signed.join(of.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    else:
        rows = stored(src.withColumn("vertex", F.monotonically_increasing_id()), "vertices")
        signed, links = _links(rows.filter("doc_id is not null").select(F.col("vertex").alias("doc_id"), "text").unionByName(rows.filter("doc_id is null").select("doc_id", "text")), k, percent)
        first = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("vertex").alias("a"))
        of = components(links.unionByName(rows.select("doc_id", F.col("vertex").alias("b")).join(first, "doc_id").select("a", "b")))
        named = rows.filter("doc_id is not null").select("doc_id", "vertex").join(of.withColumnRenamed("id", "vertex"), "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))
        least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
        named = join_groups(named, least, ["component"], "size", named.count()).select("vertex", F.col("doc_id").alias("id"), "component_id")
        out = signed.join(named, F.col("doc_id") == F.col("vertex"), "left").select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_verified(percent), "a long, b long")


def drop_near(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that stay: of each group of near-duplicates the one with the smallest id.

    Rows without id all stay.  Rows that repeat an id and a text are one row; an id on several
    texts is as many documents, the one with the smallest digest first.
    """
    known = docs.filter(F.col(id_col).isNotNull())
    if known.groupBy(id_col).count().filter("count > 1").isEmpty():
        gone = near_duplicates(docs, k, percent, id_col, text_col).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone"))
        return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    rows = known.withColumn("__digest", F.md5(whole(text_col))).dropDuplicates([id_col, "__digest"])
    rows = stored(rows.withColumn("__vertex", F.monotonically_increasing_id()), "vertices")
    of = near_duplicates(rows, k, percent, "__vertex", text_col).select(F.col("doc_id").alias("__vertex"), "component_id")
    first = rows.select("__vertex", F.struct(F.col(id_col).alias("id"), "__digest").alias("first")).join(of, "__vertex").groupBy("component_id").agg(F.min("first").alias("first"))
    keep = first.select(F.col("first.id").alias("__keep"), F.col("first.__digest").alias("__kept_digest"))
    stay = rows.join(keep, (F.col(id_col) == F.col("__keep")) & (F.col("__digest") == F.col("__kept_digest")), "left_semi")
    return stay.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
