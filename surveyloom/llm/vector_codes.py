"""Vector code compression: product codebooks over integers, nearest entries found by LAESA pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import join_groups, stored

#: Components become integers of 1 / SCALE.
SCALE = 4096
#: Greatest component, in bits; one beyond it has no exact place in a double and counts as not finite.
BITS = 53
#: Below so many bits a part's squared distance fits a long for parts of up to 32 components; above it, Python integers are used.
LONG_BITS = 28
#: Vectors that are numpy arrays at a time in a task.
ROWS = 4096


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of each component as long; null if the vector or a component is null, not finite or of more than BITS bits."""
    doubles = F.transform(vector, lambda x: x.cast("double") * SCALE)
    exact = F.forall(doubles, lambda x: F.coalesce(F.abs(x) < float(2**BITS), F.lit(False)) & ~F.isnan(x))
    return F.when(exact, F.transform(doubles, lambda x: F.floor(x).cast("long")))


def choose_pivots(book: np.ndarray, n: int) -> np.ndarray:
    """Of a part's first entries the n that lie farthest apart: each next one has the greatest sum of distances to those chosen, ties to the lower index."""
    if len(book) == 0:
        return book
    far = np.array([[np.sqrt(float(d)) for d in squared(book, e)] for e in book])
    chosen = [0]
    while len(chosen) < min(n, len(book)):
        total = far[:, chosen].sum(axis=1)
        total[chosen] = -1.0
        chosen.append(int(total.argmax()))
    return book[chosen]


def squared(parts: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts (rows) to an entry; integers of any size if the arrays hold Python integers."""
    apart = parts - entry
    return (apart * apart).sum(axis=1)


def _whole(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as longs where squares of differences fit, else as Python integers."""
    top = max([int(np.abs(a.astype(np.int64)).max()) for a in (parts, book) if a.size] or [0])
    width = max(1, parts.shape[1])
    if top < 1 << LONG_BITS and 4 * width * top * top < 1 << 62:
        return parts.astype(np.int64), book.astype(np.int64)
    return parts.astype(object), book.astype(object)


def nearest(parts: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, ties to the lower one; its squared distance; distances evaluated) for each part.

    to_pivots holds the distances of the parts to the fixed pivots.  |d(part, pivot) - d(pivot,
    entry)|, lowered by more than the error of the stored distances, bounds d(part, entry) from
    below; entries are evaluated in the order of their bounds, and a part is done when the next
    bound is above its best distance.
    """
    n, size = len(parts), len(book)
    parts, book = _whole(parts, book)
    to_entries = np.array([[np.sqrt(float(d)) for d in squared(book, p)] for p in pivots.astype(book.dtype)]).reshape(len(pivots), size)
    bound = np.zeros((n, size))
    for j in range(len(pivots)):
        mine = to_pivots[:, j].astype(np.float64)[:, None]
        error = 1e-6 * (mine + to_entries[j]) + 1e-3
        np.maximum(bound, np.abs(mine - to_entries[j]) - error, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best, at = np.empty(n, dtype=parts.dtype), np.full(n, size, dtype=np.int64)
    evaluated, open_rows = 0, np.arange(n)
    for rank in range(size):
        entry = order[open_rows, rank]
        if rank:
            reach = bound[open_rows, entry]
            going = reach * reach <= best[open_rows].astype(np.float64) * (1 + 1e-9)
            open_rows, entry = open_rows[going], entry[going]
            if not len(open_rows):
                break
        apart = parts[open_rows] - book[entry]
        d = (apart * apart).sum(axis=1)
        evaluated += len(open_rows)
        if rank:
            better = (d < best[open_rows]) | ((d == best[open_rows]) & (entry < at[open_rows]))
            rows = open_rows[better]
            best[rows], at[rows] = d[better], entry[better]
        else:
            best[open_rows], at[open_rows] = d, entry
    return at, best, evaluated


def _matrix(batch: pa.RecordBatch, name: str, width: int, kind: type) -> np.ndarray:
    column = batch.column(name)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(batch.num_rows, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def pivot_distances(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """rows (vec_id, label, v) with their parts' distances to the fixed pivots, taken once: ``to_pivots``, part by part, as floats."""
    width = books[0].shape[1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            v = _matrix(batch, "v", width * len(pivots), np.int64)
            out = []
            for i, own in enumerate(pivots):
                part, entries = _whole(v[:, i * width : (i + 1) * width], own)
                out += [np.sqrt(squared(part, e).astype(np.float64)) for e in entries]
            flat = np.stack(out, axis=1).astype(np.float32)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "to_pivots"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(measured, f"{schema}, to_pivots array<float>")


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(parts, nearest entries, squared distances, distances evaluated) of each part position of a batch."""
    width, n = books[0].shape[1], len(pivots[0])
    v, d = _matrix(batch, "v", width * len(books), np.int64), _matrix(batch, "to_pivots", n * len(books), np.float32)
    for i, book in enumerate(books):
        part = v[:, i * width : (i + 1) * width]
        yield part, *nearest(part, d[:, i * n : (i + 1) * n], pivots[i], book)


def part_sums(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, s0, s1, ..., evaluated): number and component sums of the parts nearest to each entry that has any.

    A task returns one row per entry for all it has read, so what is shuffled doesn't grow with
    the vectors; sums are exact decimals.
    """
    width, size = books[0].shape[1], len(books[0])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, evaluated = np.zeros((len(books), size), dtype=np.int64), np.zeros((len(books), size, width), dtype=object), np.zeros(len(books), dtype=np.int64)
        for batch in _slices(batches):
            for i, (part, at, _, n) in enumerate(_assigned(batch, books, pivots)):
                evaluated[i] += n
                count[i] += np.bincount(at, minlength=size)
                order = np.argsort(at, kind="stable")
                used, starts = np.unique(at[order], return_index=True)
                # At most ROWS components of BITS bits: a slice's sums fit a long.
                total[i, used] += np.add.reduceat(part[order], starts, axis=0).astype(object)
        used = [(i, e) for i in range(len(books)) for e in range(size) if count[i, e]]
        if used:
            whole = pa.decimal128(38, 0)
            sums = [pa.array([int(total[i, e, j]) for i, e in used]).cast(whole) if max(abs(int(total[i, e, j])) for i, e in used) < 1 << 62 else pa.array([str(total[i, e, j]) for i, e in used]).cast(whole) for j in range(width)]
            first = {}
            counted = [int(evaluated[i]) if first.setdefault(i, e) == e else 0 for i, e in used]
            columns = [pa.array([i for i, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([int(count[i, e]) for i, e in used], pa.int64()), *sums, pa.array(counted, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *[f"s{j}" for j in range(width)], "evaluated"])

    names = [f"s{j}" for j in range(width)]
    out = rows.select("v", "to_pivots").mapInArrow(summed, "part int, entry int, n long, " + ", ".join(f"{s} decimal(38,0)" for s in names) + ", evaluated long")
    return out.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names], F.sum("evaluated").alias("evaluated"))


def codes(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): the parts' entries, two hex digits each, and the sum of their squared distances as decimal(38,0)."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            at, error = np.zeros((batch.num_rows, len(books)), dtype=np.uint8), np.zeros(batch.num_rows, dtype=object)
            for i, (_, entries, d, _) in enumerate(_assigned(batch, books, pivots)):
                at[:, i] = entries
                error = error + d.astype(object)
            text = [row.tobytes().hex() for row in at]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array([str(int(e)) for e in error], pa.string())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = rows.select("vec_id", "label", "v", "to_pivots").mapInArrow(coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error string")
    return out.withColumn("error", F.col("error").cast("decimal(38,0)"))


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def train(rows: DataFrame, first: list[list[int]], parts: int, rounds: int, n_pivots: int) -> tuple[DataFrame, list[np.ndarray], list[np.ndarray], list[int]]:
    """(rows with distances to the pivots, the final codebooks, the pivots, distances evaluated by round) from the vectors that start the codebooks.

    A round is one pass over the stored rows; only entries' sums (parts times entries rows)
    come to the driver.
    """
    start = np.array(first, dtype=np.int64)
    width = start.shape[1] // parts
    books = [start[:, i * width : (i + 1) * width].copy() for i in range(parts)]
    pivots = [choose_pivots(_whole(b, b)[1], n_pivots).astype(np.int64) for b in books]
    rows, evaluated = stored(pivot_distances(rows, books, pivots), "vector-parts"), []
    for _ in range(rounds):
        sums = part_sums(rows, books, pivots).collect()
        evaluated.append(sum(r["evaluated"] for r in sums))
        for r in sums:
            books[r["part"]][r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return rows, books, pivots, evaluated


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, n_pivots: int = 8) -> DataFrame:
    """One row per kept vector: (vec_id, code, error, label_error, codebooks_sha256).

    Components are integers floor(4096 * x); a vector is cut into ``parts`` equal parts, each
    coded by the nearest of ``entries`` (at most 256) codebook entries.  Codebooks start as the
    parts of the smallest ids and are refined for ``rounds`` rounds; sums and distances are
    exact, so the result doesn't depend on how rows are dealt out.

    A vector is dropped if it is null, holds a null, an infinite or not-a-number component or
    one of 2**41 or more, whose integer isn't exact, or if its length isn't a positive
    multiple of ``parts`` or isn't that of the kept vector with the smallest id.  Rows without
    id come last in the order of ids; of rows that repeat an id the smaller integers come first;
    all are returned.  With fewer vectors than entries the codebooks are as short.  An error (or
    a sum) beyond a long is null.  Rows without label are one label.  An empty table, or one
    without kept vectors, gives no rows.  Other columns are ignored, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits: entries must be 1 to 256")
    whole = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), integers(F.col(vector_col)).alias("v"))
    whole = whole.filter(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0))
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    lead = whole.orderBy(*by_id).limit(1).collect()
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    if not lead:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    rows = whole.filter(F.size("v") == len(lead[0]["v"]))
    first = [r["v"] for r in rows.orderBy(*by_id).limit(entries).collect()]
    rows, books, pivots, _ = train(rows, first, parts, rounds, n_pivots)
    coded = stored(codes(rows, books, pivots).withColumn("key", F.to_json(F.struct("label"))), "vector-codes")
    labels = stored(coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "vector-labels")
    out = join_groups(coded, labels, ["key"], "n", coded.count())
    long = lambda c: F.col(c).try_cast("long").alias(c)
    return out.select("vec_id", "code", long("error"), long("label_error"), F.lit(books_digest(books)).alias("codebooks_sha256"))
