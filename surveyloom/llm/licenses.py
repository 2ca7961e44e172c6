"""Licence scans by canonical digest lookup."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import whole

# Licence names and the notices by which they are known.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
]
# Spellings that count as the same, without spaces; the second one stands for both.
SPELLINGS = [
    ("licence", "license"), ("organis", "organiz"), ("authoris", "authoriz"), ("recognis", "recogniz"), ("realis", "realiz"), ("utilis", "utiliz"), ("initialis", "initializ"), ("customis", "customiz"),
    ("favour", "favor"), ("behaviour", "behavior"), ("colour", "color"), ("honour", "honor"), ("labour", "labor"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("fulfill", "fulfil"),
    ("willful", "wilful"), ("artefact", "artifact"), ("analogue", "analog"), ("whilst", "while"), ("https", "http"), ("copyrightholder", "copyrightowner"),
]
#: A line that is a copyright notice: it begins with one, and a sign, a year or a place-holder follows. (Java; RE2 takes it without the d.)
NOTICE = r"(?md)^[^\p{L}\p{N}\n]*(copyright[^\p{L}\p{N}\n]*(\(c\)|©|[0-9\[<{]|by )|\(c\)[^\p{L}\p{N}\n]*[0-9<]|©)[^\n]*"
SIGNS = r"[^\p{L}\p{N}\n]+"
VERSION = r"(^|[ \n])v(ersion|er)? ?([0-9])"


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): the notices, and the whole texts beside this module, with and without their title line and ``All rights reserved.`` after the copyright line."""
    out = list(NOTICES)
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        title, _, rest = text.lstrip("\n").partition("\n")
        for form in dict.fromkeys((text, rest if "icense" in title and rest.startswith("\n") else text)):
            reserved = re.sub(r"(?mi)^(copyright \(c\) <.*)$", r"\1\nAll rights reserved.", form)
            out += [(path.stem.removesuffix(".notice"), t) for t in dict.fromkeys((form, reserved))]
    return out


def canonical_lines(text: Column) -> Column:
    """The text in lower case without copyright lines, signs and spaces, one spelling for equivalent ones, version numbers without ``version``; lines are kept apart by \\n."""
    c = F.regexp_replace(F.lower(whole(text)), NOTICE, "")
    c = F.regexp_replace(F.regexp_replace(c, SIGNS, " "), VERSION, "$1$3")
    c = F.replace(c, F.lit(" "), F.lit(""))
    for said, meant in SPELLINGS:
        c = F.replace(c, F.lit(said), F.lit(meant))
    return c


def canonical(lines: Column) -> Column:
    """The canonical form of a whole text from that of its lines: what a line break had kept apart is one spelling too."""
    c = F.replace(lines, F.lit("\n"), F.lit(""))
    for said, meant in SPELLINGS:
        c = F.replace(c, F.lit(said), F.lit(meant))
    return c


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(digest, license_id, n), one row per canonical text of n characters: a table of fixed size. Of licences with the same one the first by name."""
    frame = spark.createDataFrame(known, "license_id string, known_text string").withColumn("c", canonical(canonical_lines(F.col("known_text"))))
    return frame.groupBy(F.md5("c").alias("digest")).agg(F.min("license_id").alias("license_id"), F.max(F.length("c")).alias("n"))


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, digest, license_id, n_license_lines, line_license_ids).

    The canonical digest of the whole text is hash-joined to those of the known texts
    (known_texts(), or (licence, text) pairs of the caller); license_id is null where it
    matches none.  Each line is looked up as a text of its own: n_license_lines counts the
    lines that are a known text, line_license_ids has their names, sorted and without repeats,
    joined by commas ('' where there are none).  Lines of any length are looked up; only
    those whose canonical length some known text has need a digest.

    Null text is empty, and matches nothing, as a text that is canonically empty does.  Rows
    that repeat an id are scanned each.  An empty table gives an empty result.  Other columns
    are ignored, whatever their names.
    """
    digests = known_digests(docs.sparkSession, known if known is not None else known_texts())
    pairs = [(r["digest"], r["license_id"], r["n"]) for r in digests.collect()]
    table = docs.sparkSession.createDataFrame([p[:2] for p in pairs], "digest string, license_id string")
    lookup = F.create_map(*[F.lit(x) for pair in pairs for x in pair[:2]])
    lengths = F.array(*[F.lit(n) for n in sorted({p[2] for p in pairs})])
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))
    candidates = F.filter(F.split("lines", "\n"), lambda x: F.array_contains(lengths, F.length(x)))
    found = F.filter(F.transform(candidates, lambda x: F.try_element_at(lookup, F.md5(x))), lambda x: x.isNotNull())
    rows = rows.select("doc_id", F.md5(canonical(F.col("lines"))).alias("digest"), found.alias("found"))
    rows = rows.join(F.broadcast(table), "digest", "left")
    return rows.select("doc_id", "digest", "license_id", F.size("found").cast("long").alias("n_license_lines"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_license_ids"))
