"""Vector best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored, whole

#: Pieces that one task packs; the shards are dealt out by hash, so each has the same mixture of lengths.
SHARD = 10_000
END_ID = 2
#: Different words whose ids a worker keeps, and the longest that it keeps.
KEPT_WORDS, KEPT_LENGTH = 300_000, 64
#: Texts of these characters alone are cut into words here: on their categories all Unicode versions agree.
_PLAIN = re.compile(r"[\t\n\r -~\u00a1-\u024f]*")


def plain_pattern(pattern: str) -> re.Pattern:
    """The word pattern for texts that _PLAIN matches, as one of ``re``: the classes of letters and numbers are written out."""
    letters, numbers = (re.escape("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind)) for kind in "LN")
    written = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
    return re.compile(written.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]"))


class Encoder:
    """Token ids by ``tokenizers``, whose ids of a word are kept: texts repeat their words.

    The vocabulary's file cuts a text into words by a pattern and merges inside them only, so
    ids of words in a row are those of the text.  A text in which the tokenizer may cut
    otherwise, with its special tokens or uncommon characters, is encoded as a whole.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.words, self.ids = Tokenizer.from_file(path), plain_pattern(pattern), {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if not _PLAIN.fullmatch(text) or any(t in text for t in self.special):
            return self._whole(text)
        out, known = [], self.ids
        for w in self.words.findall(text):
            ids = known.get(w)
            if ids is None:
                ids = self._whole(w)
                if len(w) <= KEPT_LENGTH and len(known) < KEPT_WORDS:
                    known[w] = ids
            out += ids
        return out


@lru_cache(maxsize=4)
def encoder(name: str = "byte_bpe_50k") -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path(f"{name}.json"), public_tokenizers.PATTERN)


def _pieces(limit: int, name: str, with_ids: bool):
    def run(batches):
        encode = encoder(name)
        for batch in batches:
            doc, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(t.as_py()), END_ID], dtype="<u4")
                n = len(ids)
                edges = [0, *range(n % limit or limit, n + 1, limit)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    doc.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        kept.append(ids[a:b].astype(np.int32))
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.list_(pa.int32()))] if with_ids else []), names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return run


def best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, first size already used in it): items by falling first size, each to the bin with room in every dimension that leaves the least weighted norm of residuals; else to a new bin."""
    n, dims = sizes.shape
    order = np.lexsort((np.arange(n), -sizes[:, 0]))
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    scale = np.sqrt(weights) / capacity
    room = np.zeros((dims, n), np.float64)
    names = np.zeros(n, np.int64)
    opened, total, least = 0, 0, sizes[:, 0].min() if n else 0
    for step, item in enumerate(order):
        x = sizes[item]
        if step % 256 == 0 and opened:  # bins in which nothing fits any more are left out
            keep = room[0, :opened] >= least
            k = int(keep.sum())
            room[:, :k], names[:k] = room[:, :opened][:, keep], names[:opened][keep]
            opened = k
        left = room[:, :opened] - x[:, None]
        fits = left.min(axis=0) >= 0 if opened else np.zeros(0, bool)
        if fits.any():
            at = np.flatnonzero(fits)
            best = at[np.argmin(((left[:, at] * scale[:, None]) ** 2).sum(axis=0))]
        else:
            best = opened
            room[:, best] = capacity
            names[best] = total
            opened, total = opened + 1, total + 1
        where[item] = names[best]
        offset[item] = capacity[0] - room[0, best]
        room[:, best] -= x
    return where, offset


def _pack(limit: int, max_docs: int, max_attention: int, weights: tuple[float, float, float]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        length = table.column("length").to_numpy().astype(np.float64)
        sizes = np.stack([length, np.ones(len(length)), length**2], axis=1)
        where, offset = best_fit(sizes, np.array([limit, max_docs, max_attention], np.float64), np.array(weights))
        shard = table.column("shard")[0].as_py()
        return table.append_column("sequence_id", pa.array((np.int64(shard) << np.int64(32)) + where, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack_documents(
    docs: DataFrame, limit: int = 1024, max_docs: int | None = None, max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    tokenizer: str = "byte_bpe_50k", with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]).

    A document is its tokens and an end token.  Sequences hold at most ``limit`` tokens,
    ``max_docs`` pieces and ``max_attention`` (sum of squared lengths); None means what a full
    sequence can hold at most.  A document of more tokens than a sequence can take, by
    ``limit`` or as a square by ``max_attention``, is cut into pieces of so many, the first of
    which may be shorter.  A piece of ``limit`` tokens is a sequence of its own.  The others are
    dealt out by hash in shards of about SHARD, and packed by vector best-fit under all three
    capacities; a shard leaves at most a few sequences less full than one packing of all would.

    Null text is empty: its end token alone.  Rows that repeat an id are packed each.  An
    empty table gives an empty result.  Ids are cast to long; other columns are ignored,
    whatever their names.
    """
    max_docs, max_attention = max_docs or limit, max_attention or limit**2
    cut = min(limit, math.isqrt(max_attention))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    pieces = stored(src.mapInArrow(_pieces(cut, tokenizer, with_ids), schema), "pieces")
    full = pieces.filter(F.col("length") == limit).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < limit)
    shards = max(1, -(-rest.count() // SHARD))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    packed = rest.groupBy("shard").applyInArrow(_pack(limit, max_docs, max_attention, weights), f"{schema}, shard long, sequence_id long, offset long").drop("shard")
    return full.unionByName(packed)
