"""Secret scans by an incremental blob ledger: texts are addressed by content and scanned once for each version of a rule."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import join_groups, scratch_root, sliced, stored, whole

_LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string, kind:string, start:long, end:long>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern, leftmost and without overlap, of which those stay that ``long_enough`` lets through. A changed rule needs a new version."""

    kind: str
    version: int
    pattern: re.Pattern
    long_enough: Callable[[re.Match], bool] = lambda m: True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.pattern.finditer(text) if self.long_enough(m)]


def _at_least(group: int, n: int) -> Callable[[re.Match], bool]:
    return lambda m: m.end(group) - m.start(group) >= n


#: The base rules, in the order of their kinds; a shorter run of these characters can't hold a longer one, so the length is part of the pattern where a match is a whole run.
BASE = (
    Rule("assign", 1, re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), _at_least(2, 6)),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]{16,}")),
    Rule("hex", 1, re.compile(r"[0-9a-f]{24,}")),
)
#: Further rules: private keys in armour, tokens with a fixed prefix, signed web tokens.
MORE = (
    Rule("pem", 1, re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?")),
    Rule("prefixed", 1, re.compile(r"(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}")),
    Rule("jwt", 1, re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
)


def content_address(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(whole(text), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows (blob, rules that were scanned for, spans found); none where there is no ledger yet."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], _LEDGER)
        raise


def _scan(batches: Iterator[pa.RecordBatch], rules: dict[str, Rule]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 200):
        found = []
        for text, names in zip(batch.column("text").to_pylist(), batch.column("rules").to_pylist(), strict=True):
            found.append([{"rule": name, "kind": rules[name].kind, "start": a, "end": b} for name in names for a, b in rules[name].spans(text)])
        kind = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("rules"), pa.array(found, kind)], ["blob", "rules", "spans"])


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Scan what the ledger doesn't know of versions (path, text) and append it; returns (path, blob) of all versions.

    Each content is one blob, however many versions and paths it has.  A pair of a blob and a
    rule's version is scanned once: a new version of one rule scans known blobs for that rule
    alone.  A ledger row holds a blob, the rules that it was scanned for and what was found,
    nothing too, so a row is the proof of its scan: a run that is lost before it is written is
    done again, and one that is written twice says the same twice.

    Only digests are grouped; of each content the text of one path is moved and scanned.  Rows
    without path, and rows that repeat a path and a text, are versions like others.
    """
    by_name = {r.name: r for r in rules}
    if len(by_name) < len(rules):
        raise ValueError("two rules of one kind need versions of their own")
    named = versions.select(F.col("path"), content_address(F.col("text")).alias("blob"))
    named = stored(named, "blob-paths")
    wanted = F.array(*[F.lit(n) for n in by_name])
    seen = read_ledger(versions.sparkSession, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    # One path stands for a blob; null only where no other has it.
    blobs = named.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left")
    todo = blobs.select("blob", "path", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")).filter(F.size("rules") > 0)
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    todo = todo.select(F.col("blob").alias("__blob"), "rules", key("path").alias("__key"))
    texts = versions.select(key("path").alias("key"), whole("text").alias("text"), content_address(F.col("text")).alias("blob"))
    fresh = texts.join(todo, (F.col("key") == F.col("__key")) & (F.col("blob") == F.col("__blob"))).select("blob", "text", "rules")
    fresh.mapInArrow(lambda batches: _scan(batches, by_name), _LEDGER).write.mode("append").parquet(ledger)
    return named


def findings(named: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(path, blob, spans) of all versions: what the ledger holds for their blobs and these rules, by start, then rule."""
    names = [r.name for r in rules]
    rank = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    own = F.filter("spans", lambda s: s["rule"].isin(names))
    found = read_ledger(named.sparkSession, ledger).select("blob", F.explode(own).alias("s"))
    # A pair that two runs have written is one.
    found = found.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(F.col("s.start").alias("start"), F.try_element_at(rank, F.col("s.rule")).alias("rank"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind")))).alias("spans"))
    sizes = named.groupBy("blob").agg(F.count("*").alias("n_paths"))
    found = stored(found.join(sizes, "blob"), "blob-findings")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return join_groups(named, found, ["blob"], "n_paths", named.count(), "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def scan_secrets(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_assign, n_access, n_hex, base_sha256, spans).

    The counts and the digest are of the base rules, ``spans`` holds all: kind:start:end by
    start, then kind, joined by commas; positions are code points, ends exclusive.  Null text is
    empty and has none.  Rows without id and repeated rows are returned like others; an empty
    table gives none; other columns are ignored, whatever their names.  With a ledger (a folder
    all executors see) later calls scan new contents and new rule versions only; without one
    a new ledger in the scratch folder is filled.
    """
    spark = docs.sparkSession
    ledger = ledger or f"{scratch_root(spark)}/ledger-{uuid.uuid4().hex}"
    named = scan_unseen(docs.select(F.col(id_col).alias("path"), F.col(text_col).alias("text")), ledger)
    rows = findings(named, ledger)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("spans", lambda s: s["rank"] == i)).cast("long").alias(f"n_{BASE[i].kind}")
    return rows.select(F.col("path").alias("doc_id"), *[count(i) for i in range(len(BASE))], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))

