"""Exact removal of repeated byte strings by induced sorting of sampled suffixes.

A literal sort of all suffixes moves many times the input.  As in induced sorting, only
sampled suffixes are sorted, and what holds for the others is induced from them.  A suffix is
sampled where its first KEY bytes have the least hash of a span of ``length`` bytes (the
rightmost of equal ones), so equal spans hold equal samples at equal places, and each span
belongs to one sample.  The spans of a sample are consecutive; together they are its run.

1. Tuples (name of the sample's first KEY bytes, name of its whole run, document, place) are
   dealt out by the first name and sorted by both names and document.  Equal run names mean
   that all spans are equal: the run is repeated in all but the first document.
2. Runs that share the sample but not the run recur one level deeper, with their bytes.
   There the sampled suffixes are sorted by their bytes with the common prefix of each
   neighbour, and their reversed left contexts likewise.  A span that begins o bytes before
   its sample is a suffix induced from it: two of them are equal where the sorted samples
   share length - o bytes to the right and o bytes to the left, which the common prefixes
   tell for every o.
3. A sample that very many documents hold with different neighbours (the edge of a widely
   copied passage) would gather them all in one group.  Tasks that meet such a name pass its
   runs by, and tell its group; each of their spans then is a tuple of its own, dealt out by
   the whole span.

Names are hashes, of 56 bits for a run besides 40 or more for its sample.  Spark's shuffle
deals tuples out to buckets on disk; sorting is done in a bucket, whose number follows the
input, so a bucket's tuples fit in a task.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import wordhash
from .common import buckets, partitions, sliced, stored, whole

#: Bytes of a sample's name.  More bytes: fewer accidental equals, but more samples.
KEY = 24
#: Bytes of text that one task holds as numpy arrays at a time.
CHUNK = 1 << 20
#: Different runs of one sample name that a task meets, from which the name is hot for it.
HOT = 256
#: Different runs of one sample name that are compared as a group.
CROWD = 50_000
#: Tuples that a task gathers before it deals them out, so that a bucket gets them in few rows.
GATHERED = 500_000
#: Names and runs that a task keeps in mind.
MEMORY = 200_000
_NAME_BITS = np.uint64(40)
_NAME = np.uint64((1 << 40) - 1)


def _cut(a: np.ndarray, n: int) -> bytes:
    """The low n bytes of each 64-bit value."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _uncut(b: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(b) // n, 8), dtype=np.uint8)
    out[:, :n] = np.frombuffer(b, dtype=np.uint8).reshape(-1, n)
    return out.view(np.uint64).ravel()


def runs(texts: list[bytes], length: int):
    """(text index, start, last start, sample hash, run hash) of each run of the texts' spans."""
    buf, begins = wordhash.joined(texts)
    n = len(buf)
    empty = np.zeros(0, dtype=np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = wordhash.prefix_sums(buf)
    at = np.arange(n - KEY + 1)
    names = wordhash.range_hashes(sums, at, at + KEY)
    least, where, width, need = names, at.astype(np.int32), 1, length - KEY + 1
    while width < need:
        step = min(width, need - width)
        right = least[step:] <= least[:-step]
        where = np.where(right, where[step:], where[:-step])
        least = np.where(right, least[step:], least[:-step])
        width += step
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))[: len(where)]
    valid = np.arange(len(where)) + length <= begins[owner + 1] - 1
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (where[1:] != where[:-1]) | (owner[1:] != owner[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | first[1:]
    a, z = np.flatnonzero(first), np.flatnonzero(last)
    doc = owner[a]
    return doc, a - begins[doc], z - begins[doc], names[where[a]], wordhash.range_hashes(sums, a, z + length)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping or touching intervals of a document joined."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    change = np.concatenate([[True], doc[1:] != doc[:-1]])
    group = np.cumsum(change) - 1
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = change.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.concatenate([at[1:], [len(doc)]]) - 1]


def _smallest(keys: tuple[np.ndarray, ...], doc: np.ndarray):
    """Order by keys and document, and for each row in that order its group and the smallest document of the group."""
    order = np.lexsort((doc, *reversed(keys)))
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    group = np.cumsum(new) - 1
    return order, group, doc[order][new][group]


class _Memory:
    """Keys with a value each, sorted; at most MEMORY of them, the latest first."""

    def __init__(self):
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def at(self, keys: np.ndarray, otherwise: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), otherwise, np.int64)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.values[i], otherwise)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """keys: each once."""
        old = ~np.isin(self.keys, keys)
        room = max(0, MEMORY - len(keys))
        k, v = np.concatenate([self.keys[old][:room], keys]), np.concatenate([self.values[old][:room], values])
        order = np.argsort(k)
        self.keys, self.values = k[order], v[order]


class _Gathered:
    """Tuples by kind until they are dealt out: 0 for a name's bucket, 2 of hot names, 3 hot names; and packed intervals settled already (1)."""

    def __init__(self, n_buckets: int):
        self.n_buckets = n_buckets
        self.clear()

    def clear(self) -> None:
        self.tuples: dict[int, list] = {0: [], 2: [], 3: []}
        self.rows: list[tuple[int, int, bytes]] = []
        self.count = 0

    def add(self, kind: int, *columns: np.ndarray) -> None:
        self.tuples[kind].append(columns)
        self.count += len(columns[0])

    def dealt(self):
        """One batch of packed rows, if there is anything."""
        n, rows = np.uint64(self.n_buckets), self.rows
        for kind, found in self.tuples.items():
            if found:
                name, *rest = (np.concatenate(x) for x in zip(*found, strict=True))
                by = rest[0] if kind == 2 else name >> _NAME_BITS
                columns = ((name, 5), *zip(rest, (7, 8, 4, 1), strict=False))
                rows += _packed((by % n).astype(np.int64), kind, columns)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "tuples"])
        self.clear()


def _sample(length: int, n_buckets: int, hot_from: int):
    def run(batches):
        crowds, settled, gathered = _Memory(), _Memory(), _Gathered(n_buckets)
        for batch in sliced(batches):
            ids, texts = batch.column(0).to_pylist(), [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            order = sorted(range(len(ids)), key=ids.__getitem__)
            for some, chunk in wordhash.chunks([ids[i] for i in order], [texts[i] for i in order], CHUNK):
                _sampled_chunk(np.array(some, dtype=np.int64), chunk, length, hot_from, crowds, settled, gathered)
                if gathered.count > GATHERED:
                    yield from gathered.dealt()
        yield from gathered.dealt()

    return run


def _sampled_chunk(ids, texts, length, hot_from, crowds: _Memory, settled: _Memory, gathered: _Gathered) -> None:
    doc, start, last, name, content = runs(texts, length)
    if not len(doc):
        return
    doc = ids[doc]
    order, group, least = _smallest((name, content), doc)
    doc, start, last, name, content = doc[order], start[order], last[order], name[order], content[order]
    # Repeats inside the task are settled here, so a passage that a third of all documents share sends few tuples a task.
    both = wordhash.mix(name) + content
    before = settled.at(both, np.iinfo(np.int64).max)
    least = np.minimum(least, before)
    first = np.concatenate([[True], group[1:] != group[:-1]])
    often = first & (np.bincount(group)[group] > 1)
    settled.put(*(x[np.unique(both[often], return_index=True)[1]] for x in (both[often], least[often])))
    again = doc > least
    d, s, e = merged(doc[again], start[again], last[again] + length)
    if len(d):
        gathered.rows.append((int(ids[0]) % gathered.n_buckets, 1, struct.pack("<q", len(d)) + d.tobytes() + s.astype(np.int64).tobytes() + e.astype(np.int64).tobytes()))
    order = np.lexsort((start[~again], doc[~again]))  # near values in a row take less room
    doc, start, last, name, content = (x[~again][order] for x in (doc, start, last, name, content))
    names, place, count = np.unique(name, return_inverse=True, return_counts=True)
    had = crowds.at(names, 0)
    total = had + count
    crowds.put(names[(count > 1) | (had > 0)], total[(count > 1) | (had > 0)])
    hot = total >= hot_from
    columns = (name, content, doc, start.astype(np.uint32), (last - start).astype(np.uint8))
    for part, kind in ((~hot[place], 0), (hot[place], 2)):
        gathered.add(kind, *(x[part] for x in columns))
    gathered.add(3, names[hot & (had < hot_from)])


def _packed(bucket: np.ndarray, kind: int, columns) -> list[tuple[int, int, bytes]]:
    """(bucket, kind, bytes) rows: for each bucket its number of tuples, then their columns (array, bytes kept of a value)."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    out = []
    for some in np.split(order, edges):
        if len(some):
            out.append((int(bucket[some[0]]), kind, struct.pack("<q", len(some)) + b"".join(_cut(x[some], n) if n < x.itemsize else x[some].tobytes() for x, n in columns)))
    return out


def _unpacked(rows: list[bytes], columns) -> list[np.ndarray]:
    """The columns (type, bytes kept of a value) of packed rows, each as one array."""
    found = [[np.zeros(0, kind)] for kind, _ in columns]
    for data in rows:
        n, at = struct.unpack_from("<q", data)[0], 8
        for x, (kind, size) in zip(found, columns, strict=True):
            part = data[at : at + size * n]
            x.append(np.frombuffer(part, kind) if size == np.dtype(kind).itemsize else _uncut(part, size).astype(kind))
            at += size * n
    return [np.concatenate(x) for x in found]


_SPANS = "doc_id long, kind byte, start long, end long, name long"


def _spans(doc, kind, start, end, name=None) -> pa.Table:
    n = len(doc)
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "kind": pa.array(np.full(n, kind, np.int8)), "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64()), "name": pa.array(np.zeros(n, np.int64) if name is None else name.view(np.int64))})


def _compare(length: int, crowd: int):
    """Intervals (kind 0) of repeated runs; runs that share a sample with another one (1); runs of hot samples (2)."""
    columns = ((np.uint64, 5), (np.uint64, 7), (np.int64, 8), (np.uint32, 4), (np.uint8, 1))

    def reduced(rows):
        name, content, doc, start, width = _unpacked(rows, columns)
        order, _, least = _smallest((name, content), doc)
        name, doc, start, width = (x[order] for x in (name, doc, start.astype(np.int64), width.astype(np.int64)))
        return name, doc, start, start + width + length, doc > least

    def run(table: pa.Table) -> pa.Table:
        by_kind: list[list[bytes]] = [[], [], [], []]
        for kind, data in zip(table.column("kind").to_pylist(), table.column("tuples").to_pylist(), strict=True):
            by_kind[kind].append(data)
        out = [_spans(np.zeros(0, np.int64), 0, np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for data in by_kind[1]:
            d, s, e = np.frombuffer(data, np.int64, -1, 8).reshape(3, -1)
            out.append(_spans(d, 0, s, e))
        if by_kind[0]:
            name, doc, start, end, again = reduced(by_kind[0])
            out.append(_spans(doc[again], 0, start[again], end[again]))
            name, doc, start, end = name[~again], doc[~again], start[~again], end[~again]
            new = np.concatenate([[True], name[1:] != name[:-1]])
            at, group = np.flatnonzero(new), np.cumsum(new) - 1
            hot = np.isin(name[at], _unpacked(by_kind[3], ((np.uint64, 5),))[0]) | (np.diff(np.append(at, len(name))) > crowd)
            differs = ~hot & (np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at))
            bucket = np.uint64(table.column("bucket")[0].as_py())
            for kind, some in ((1, differs[group]), (2, hot[group])):
                out.append(_spans(doc[some], kind, start[some], end[some], name[some] | (bucket << _NAME_BITS)))
        if by_kind[2]:
            name, doc, start, end, again = reduced(by_kind[2])
            out += [_spans(doc[again], 0, start[again], end[again]), _spans(doc[~again], 2, start[~again], end[~again])]
        return pa.concat_tables(out)

    return run


def _fetch(length: int, n_buckets: int):
    """Packed rows of the wanted runs, with their bytes (kind 1), or of their single spans (kind 2)."""

    def run(batches):
        found = ([], []), ([], [])
        for batch in sliced(batches):
            for i, text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.encode("utf-8", "surrogatepass")
                for s, e, h, kind in zip(*(want.values.field(k).to_pylist() for k in range(4)), strict=True):
                    tuples, parts = found[kind - 1]
                    tuples.append((i, s, h))
                    parts.append(text[s:e])
                if len(found[0][0]) > 100_000 or len(found[1][0]) > 10_000:
                    yield from _fetched(found, length, n_buckets)
                    found = ([], []), ([], [])
        yield from _fetched(found, length, n_buckets)

    return run


def _fetched(found, length, n_buckets):
    rows = []
    (tuples, parts), (hot, hot_parts) = found
    if tuples:
        doc, start, name = np.array(tuples, np.int64).T
        size = np.array([len(p) for p in parts], np.int64)
        bucket = (wordhash.mix(name.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            head = _packed(bucket[some], 1, ((doc[some], 8), (start[some], 8), (name[some], 8), (size[some], 8)))[0]
            rows.append((head[0], 1, head[2] + b"".join(parts[i] for i in some)))
    if hot:
        doc, start, _ = np.array(hot, np.int64).T
        size = np.array([len(p) for p in hot_parts], np.int64)
        sums = wordhash.prefix_sums(np.frombuffer(b"".join(hot_parts), np.uint8))
        of, offset = _places(size - length + 1)
        at = (np.cumsum(size) - size)[of] + offset
        half = length // 2
        span = wordhash.range_hashes(sums, at, at + length)
        check = wordhash.mix(wordhash.range_hashes(sums, at, at + half) * np.uint64(3) + wordhash.range_hashes(sums, at + half, at + length))
        order, _, least = _smallest((span, check), doc[of])
        again = doc[of][order] > least
        d, s, e = merged(doc[of][order][again], (start[of] + offset)[order][again], (start[of] + offset)[order][again] + length)
        if len(d):
            rows.append((int(d[0]) % n_buckets, 0, struct.pack("<q", len(d)) + d.tobytes() + s.tobytes() + e.tobytes()))
        send = np.sort(order[~again])
        rows += _packed((span[send] % np.uint64(n_buckets)).astype(np.int64), 2, ((span[send], 8), (check[send], 5), (doc[of][send], 8), ((start[of] + offset)[send].astype(np.uint32), 4)))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "tuples"])


def _places(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, 0..count-1) for every index, concatenated."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)


def _sorted_prefixes(group: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Class of each row at each depth 0..width of its context: rows of a group are in one class at a depth where so many bytes of their contexts are equal.  From the sorted order and the common prefix of each neighbour."""
    n, width = context.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = context
    order = np.lexsort((*np.ascontiguousarray(words).view(">u8").T[::-1], group))
    context, group = context[order], group[order]
    common = np.cumprod(context[1:] == context[:-1], axis=1, dtype=np.int8).sum(axis=1)
    common[group[1:] != group[:-1]] = -1
    classes = np.zeros((n, width + 1), np.int64)
    classes[order[1:]] = np.cumsum(common[:, None] < np.arange(width + 1)[None, :], axis=0)
    return classes


def _induce(length: int, n_buckets: int):
    """Intervals of repeated spans, from packed runs (kind 1) and packed single spans (kind 2)."""
    reach = length - KEY

    def of_runs(rows):
        fields, bufs = [], []
        for data in rows:
            n = struct.unpack_from("<q", data)[0]
            fields.append(np.frombuffer(data, np.int64, 4 * n, 8).reshape(4, n))
            bufs.append(data[8 + 32 * n :])
        doc, start, name, size = np.concatenate(fields, axis=1)
        # Room beyond the ends, so that contexts can be read past them; no span reaches there.
        buf = np.frombuffer(b"\0" * length + b"".join(bufs) + b"\0" * length, np.uint8)
        begin = length + np.cumsum(size) - size
        # The sample is the last place with its name among those that all spans of the run hold.
        width = size - length
        run, place = _places(reach - width + 1)
        at = begin[run] + width[run] + place
        hashed = wordhash.range_hashes(wordhash.prefix_sums(buf), at, at + KEY)
        known = name.view(np.uint64)[run]
        named = ((hashed & _NAME) == (known & _NAME)) & ((hashed >> _NAME_BITS) % np.uint64(n_buckets) == known >> _NAME_BITS)
        sample = np.zeros(len(doc), np.int64)
        np.maximum.at(sample, run[named], at[named])
        group = np.unique(name, return_inverse=True)[1]
        right = _sorted_prefixes(group, buf[sample[:, None] + np.arange(length)])
        left = _sorted_prefixes(group, buf[sample[:, None] - 1 - np.arange(reach)])
        before, after = sample - begin, begin + size - sample
        d, s = [], []
        for o in range(reach + 1):
            have = np.flatnonzero((o <= before) & (length - o <= after))
            order, _, least = _smallest((right[have, length - o], left[have, o]), doc[have])
            again = have[order][doc[have][order] > least]
            d.append(doc[again])
            s.append(start[again] + before[again] - o)
        return np.concatenate(d), np.concatenate(s)

    def of_spans(rows):
        span, check, doc, start = _unpacked(rows, ((np.uint64, 8), (np.uint64, 5), (np.int64, 8), (np.uint32, 4)))
        order, _, least = _smallest((span, check), doc)
        again = doc[order] > least
        return doc[order][again], start[order][again].astype(np.int64)

    def run(table: pa.Table) -> pa.Table:
        by_kind: list[list[bytes]] = [[], [], []]
        for kind, data in zip(table.column("kind").to_pylist(), table.column("tuples").to_pylist(), strict=True):
            by_kind[kind].append(data)
        out = [_spans(np.zeros(0, np.int64), 0, np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for data in by_kind[0]:
            d, s, e = np.frombuffer(data, np.int64, -1, 8).reshape(3, -1)
            out.append(_spans(d, 0, s, e))
        for rows, of in ((by_kind[1], of_runs), (by_kind[2], of_spans)):
            if rows:
                d, s = of(rows)
                d, s, e = merged(d, s, s + length)
                out.append(_spans(d, 0, s, e))
        return pa.concat_tables(out)

    return run


def _finish(batches):
    for batch in sliced(batches):
        out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for i, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            kept, at, removed, n = [], 0, 0, 0
            reach = -1
            for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                if s > reach:  # touching spans are one run
                    kept.append(data[at:s])
                    n += 1
                removed += max(0, e - max(s, reach))
                reach = at = max(reach, e)
            kept.append(data[at:])
            for k, v in zip(out, (i, len(data), removed, n, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), *(pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept_sha256"], pa.string())], names=list(out))


def repeated_spans(docs: DataFrame, length: int = 50, hot_from: int = HOT, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(texts dealt out by doc_id, intervals (doc_id, start, end) of bytes covered by a span that also starts in a document with a smaller id). docs: (doc_id long, text string, not null)."""
    n_buckets = buckets(docs, 4)
    known = docs.filter("doc_id is not null")
    tuples = known.mapInArrow(_sample(length, n_buckets, hot_from), "bucket long, kind byte, tuples binary")
    spans = stored(tuples.groupBy("bucket").applyInArrow(_compare(length, crowd), _SPANS), "spans")
    dealt = docs.repartition(partitions(docs), "doc_id")
    rest = spans.filter("kind > 0").groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "name", "kind")).alias("want"))
    fetched = dealt.join(rest, "doc_id").select("doc_id", "text", "want").mapInArrow(_fetch(length, n_buckets), "bucket long, kind byte, tuples binary")
    deeper = fetched.groupBy("bucket").applyInArrow(_induce(length, n_buckets), _SPANS)
    return dealt, spans.filter("kind = 0").select("doc_id", "start", "end").unionByName(deeper.select("doc_id", "start", "end"))


def remove_repeated(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", hot_from: int = HOT, crowd: int = CROWD) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a
    smaller id; strings are judged on the input and never cross documents.  n_spans counts
    the maximal removed runs, kept_sha256 is the digest of the bytes that stay.

    Null text is empty; texts shorter than ``length`` lose nothing.  Rows without id lose
    nothing and are no one's smaller document.  Whole rows that repeat are each returned with
    the same result; ids are taken to identify texts (of rows that share an id but not a
    text, spans found in one are removed from the others too).  Very long texts are hashed
    whole, one at a time.  An empty table gives an empty result.  ``length`` is more than KEY.
    hot_from and crowd (HOT, CROWD) decide how the work is dealt out, not what is found.
    Ids are cast to long; other columns are ignored, whatever their names.
    """
    if length <= KEY:
        raise ValueError(f"length must be more than {KEY} bytes")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    dealt, spans = repeated_spans(src, length, hot_from, crowd)
    per = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return dealt.join(per, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
