"""Licence scan: canonical digests of whole texts, looked up among those of known licences.

Case, punctuation, copyright lines and equivalent spellings are taken out of a text; the
SHA-256 of what is left is joined with the digests of known licence texts. Texts are the
document as a whole and each of its lines, so a licence that is a document and a licence line in
one are both found. Everything is column functions and joins; what is joined of a known licence is its digest,
so Spark broadcasts them by their size.

The known ones are the notices below and ``licence_texts.jsonl``: whole texts of common licences (with
and without title, appendix and "All rights reserved"), their standard headers, usual notices and SPDX
lines. Texts are plain characters with ’ for ', which is no part of a digest.

Null and empty texts, and texts without letters or digits, match nothing. Rows are told
apart by id and a hash of the text; rows equal in both have equal answers.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.llm.tables import null_safe_join


def _listed() -> tuple[tuple[str, str], ...]:
    with Path(__file__).with_name("licence_texts.jsonl").open(encoding="utf-8") as lines:
        return tuple((row["licence"], row["text"]) for row in map(json.loads, lines))


# Licence notices, headers and texts, by their SPDX identifiers.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    *_listed(),
)

# Spellings that licence texts are compared without.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("https://", "http://"),
)

COPYRIGHT_LINE = r"(^|\n)[^\n]*copyright[ \t]*(\(c\)|©|[0-9]{4})[^\n]*"


def prepared(text: Column) -> Column:
    """Lower case, equivalent spellings, no copyright lines; lines stay."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "$1")
    for spelling, usual in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    return out


def words_only(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, licence) of the canonical texts; a text known twice counts under its first name."""
    listed = spark.createDataFrame([(text, at, name) for at, (name, text) in enumerate(known)], "text string, at int, name string")
    digests = listed.select(F.sha2(words_only(prepared(F.col("text"))), 256).alias("digest"), "at", "name")
    return digests.groupBy("digest").agg(F.min_by("name", "at").alias("licence"))


def licence_scan(docs: DataFrame, text: str = "text", id: str = "doc_id", known=KNOWN) -> DataFrame:
    """Per row: ``doc_id``, ``whole_licence`` (null if the text is none), ``licences`` (of lines and whole, ascending), ``n_lines``."""
    lines = prepared(F.col(text))
    rows = docs.select(F.col(id).alias("doc_id"), F.xxhash64(text).alias("content"), lines.alias("lines"))
    units = rows.select(
        "doc_id",
        "content",
        F.posexplode(F.concat(F.array("lines"), F.split("lines", "\n"))).alias("place", "unit"),
    )
    canonical = units.withColumn("unit", words_only(F.col("unit"))).where("unit <> ''")
    digests = canonical.select("doc_id", "content", "place", F.sha2("unit", 256).alias("digest"))
    hits = digests.join(known_digests(docs.sparkSession, known), "digest").groupBy("doc_id", "content").agg(
        F.max(F.when(F.col("place") == 0, F.col("licence"))).alias("whole_licence"),
        F.sort_array(F.collect_set("licence")).alias("licences"),
        F.count_distinct(F.when(F.col("place") > 0, F.col("place"))).alias("n_lines"),
    )
    found = null_safe_join(rows.drop("lines"), hits, ["doc_id", "content"], "left")
    return found.select(
        "doc_id",
        "whole_licence",
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
    )
