"""Language identification: known words by log frequency, unknown ones by ever shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import sliced, stored

_WORD = re.compile(r"[^\W\d_]+")  # letters, and signs that letters() takes apart
#: Longest n-gram tried for a word that was not learned.
LONGEST = 5


def letters(text: str) -> list[str]:
    """The runs of letters (Unicode categories L) of the lower-cased text."""
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


@dataclass
class LanguageModel:
    """Log frequencies, centred over the languages, per word (grams[0]) and per n-gram of n characters (grams[n]): rows of one matrix each."""

    languages: list[str]
    grams: list[tuple[dict[str, int], np.ndarray]] = field(default_factory=list)

    def word(self, w: str) -> np.ndarray | None:
        """Scores of a word: its own if learned, else the mean of its longest n-grams of which any is known; None if none is."""
        places, scores = self.grams[0]
        if (at := places.get(w)) is not None:
            return scores[at]
        padded = f"^{w}$"
        for n in range(LONGEST, 0, -1):
            places, scores = self.grams[n]
            found = [at for i in range(len(padded) - n + 1) if (at := places.get(padded[i : i + n])) is not None]
            if found:
                return scores[found].mean(axis=0)
        return None

    def text(self, text: str | None, seen: dict) -> tuple[str, float]:
        """(language, share of the posterior); ties go to the first language by name."""
        counts = Counter(letters(text)) if text else None
        if not counts or not self.languages:
            return "und", 0.0
        totals = [0.0] * len(self.languages)
        for w, n in counts.items():
            try:
                score = seen[w]
            except KeyError:
                score = self.word(w)
                score = None if score is None else score.tolist()
                if len(seen) < 100_000:  # scores kept by a worker
                    seen[w] = score
            if score is not None:
                for i, x in enumerate(score):
                    totals[i] += n * x
        best = max(range(len(totals)), key=totals.__getitem__)
        return self.languages[best], 1.0 / sum(math.exp(max(-700.0, x - totals[best])) for x in totals)


def _centred(rows: pa.Table, languages: list[str], smoothing: float) -> tuple[dict[str, int], np.ndarray]:
    """Place of each key, and by place the centred log frequencies. rows: w (the key), lang, n (its count); only different keys become Python objects."""
    keys = rows.column("w").combine_chunks().dictionary_encode()
    places = {key: i for i, key in enumerate(keys.dictionary.to_pylist())}
    of = pc.index_in(rows.column("lang"), pa.array(languages, rows.schema.field("lang").type))
    counts = np.zeros((len(places), len(languages)))
    np.add.at(counts, (keys.indices.to_numpy(), of.to_numpy()), rows.column("n").to_numpy())
    logs = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * len(places)))
    return places, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def sampled(labelled: DataFrame, max_docs: int, max_chars: int) -> DataFrame:
    """(lang, text) of at most ``max_docs`` texts, those first by a hash, of at most ``max_chars`` characters together; each of them whole, and once however often it occurs.

    A text that doesn't fit beside those before it is passed over, so that one very long text
    changes nothing for the others.
    """
    rows = labelled.filter("lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    # Only hashes and lengths are sorted; max_docs of them, twice 8 bytes each, come to the driver.
    first = rows.groupBy("h").agg(F.max(F.length("text")).alias("n")).orderBy("h").limit(max_docs).collect()
    fits, total = [], 0
    for r in first:
        if total + r["n"] <= max_chars:
            fits.append((r["h"],))
            total += r["n"]
    chosen = labelled.sparkSession.createDataFrame(fits, "h long")
    return rows.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.min(F.struct("lang", "text")).alias("x")).select("x.lang", "x.text")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)([\p{L}]+)"))


def train(labelled: DataFrame, max_docs: int = 8000, max_chars: int = 40_000_000, smoothing: float = 0.5, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from at most ``max_docs`` labelled documents of at most ``max_chars`` characters in all.

    These two bound the model, which the driver gets and broadcasts; every word of the sample
    is learned.  Spark counts the words, and their n-grams weighted by the words' counts.
    No labelled rows give a model without languages.
    """
    sample = sampled(labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), max_docs, max_chars)
    counts = stored(sample.select("lang", F.explode(words(F.col("text"))).alias("w")).groupBy("w", "lang").agg(F.count("*").alias("n")), "words")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    model = LanguageModel(languages)
    if not languages:
        return model
    padded = F.concat(F.lit("^"), "w", F.lit("$"))
    tables = [counts.select("w", "lang", "n")]
    for size in range(1, LONGEST + 1):
        at = counts.filter(F.length(padded) >= size).select(padded.alias("p"), "lang", "n", F.explode(F.sequence(F.lit(1), F.length(padded) - size + 1)).alias("at"))
        tables.append(at.groupBy(F.substring("p", F.col("at"), F.lit(size)).alias("w"), "lang").agg(F.sum("n").alias("n")))
    for table in tables:
        model.grams.append(_centred(table.orderBy("w", "lang").toArrow(), languages, smoothing))
    pa.default_memory_pool().release_unused()  # else the driver keeps the tables' memory
    return model


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, lang_pred, score).

    score is the posterior of the predicted language under equal priors, 0 to 1.  Null texts
    and those without a letter are ``und`` with score 0; a text of letters none of which was
    learned gets the first language with an even score.  The model is bounded by train(), so
    it is broadcast.  Rows that repeat are each scored.  An empty table gives an empty result.
    Ids are cast to long; other columns are ignored, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, seen = sent.value, {}
        for batch in sliced(batches):
            found = [m.text(t, seen) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame, id_col: str = "doc_id"):
    """Whether a row is kept from training: CRC-32 of its id as text is divisible by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def identify_languages(docs: DataFrame, **kwargs) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows of docs that aren't held out.  A null id counts as not held out."""
    model = train(docs.filter(F.coalesce(~held_out(docs), F.lit(True))), **kwargs)
    return identify(docs, model).select("doc_id", F.coalesce(held_out(docs), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text has a language (null texts and those without a letter go)."""
    model = train(docs.filter(F.coalesce(~held_out(docs, id_col), F.lit(True))), text_col=text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m, seen = sent.value, {}
        for batch in sliced(batches):
            keep = [m.text(t, seen)[0] != "und" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
