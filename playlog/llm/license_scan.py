"""Licence scan by canonical digests.

A text is made canonical (lower case, notices gone, punctuation and white space to single
spaces, equivalent spellings replaced), hashed, and joined by hash to the digests of known
licences, made canonical in the same way.  Whole texts are looked up, and each whole line, as
notices stand alone in a line.

A notice is a line that begins with a copyright and a year or a (c), or that reserves all rights.
A licence wrapped anew may begin a line of its body that way, so a text with notices is also
looked up with all its lines, and the known texts have both digests.

The known licences are a parameter: at most `KNOWN` digests are broadcast, beyond that they are
joined by shuffles.  The texts of common licences lie in `licenses/`, named by their
identifiers; short ones and notices of one line are below.

Defined results: a null, empty or all-punctuation text matches nothing; repeated rows are
looked up one by one; if two known licences share a digest the smaller name is reported; whole
texts of any length are hashed; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import text_of

#: Most known licences; their digests are broadcast.
KNOWN = 10_000

# Spellings that count as equal, from left to right, where only words are left.
SPELLINGS = (
    ("sub licens", "sublicens"), ("licence", "license"), ("copyright owner", "copyright holder"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), (" fulfil ", " fulfill "),
    ("judgement", "judgment"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("wilful", "willful"), ("organisation", "organization"), ("whilst", "while"),
    (" https ", " http "),
)
#: The rest of a line that is a notice, after white space.
NOTICE = (r"(?:copyright[ \t]*(?:\(c\)|©)|copyright[ \t]+[\[<{(]?(?:yyyy|year|[0-9]{4})|"
          r"(?:\(c\)|©)[ \t]*[0-9]{4})[^\n]*|all rights reserved[. \t]*(?=\n|$)")
#: Titles that stand above the texts of these licences.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
}

# Texts of short licences, and notices that name one.
LICENSES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)


def licenses() -> list[tuple[str, str]]:
    """(name, text) of all known licences and notices, whole texts with and without titles."""
    files = sorted(resources.files("playlog.llm").joinpath("licenses").iterdir(), key=lambda f: f.name)
    known = [*LICENSES, *((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files)]
    titled = [(n, f"{title}\n\n{t}") for n, t in known if "\n" in t for title in TITLES.get(n, ())]
    return known + titled


def _notice(text: Column) -> Column:
    return F.lower(text).rlike(rf"(?:^|\n)[ \t]*(?:{NOTICE})")


def canonical(text: Column, notices: bool = False) -> Column:
    """Null if nothing is left; `notices` stay if asked."""
    t = F.lower(text)
    if not notices:
        t = F.regexp_replace(t, rf"(^|\n)[ \t]*(?:{NOTICE})", "$1")
    t = F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.trim(t)
    return F.when(t != "", t)


def digest(text: Column, notices: bool = False) -> Column:
    return F.sha2(canonical(text, notices), 256)


def known(spark, texts=None) -> DataFrame:
    """license, digest: one row per digest, of the texts with and without their notices."""
    table = spark.createDataFrame(list(licenses() if texts is None else texts),
                                  "license string, text string")
    return table.select("license", F.explode(F.array(
        digest(F.col("text")), digest(F.col("text"), notices=True))).alias("digest")).where(
        "digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, licenses: DataFrame, key: str = "doc_id", text: str = "text"
                 ) -> DataFrame:
    """Per row of `docs`: key, digest (null if nothing is left), license (of the whole text, or
    null), notices (licences of its lines, sorted, each once)."""
    few = licenses.limit(KNOWN + 1).count() <= KNOWN
    side = F.broadcast(licenses) if few else licenses.hint("merge")
    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text")).withColumn(
        "digest", digest(F.col("text"))).withColumn(
        "other", F.when(_notice(F.col("text")), digest(F.col("text"), notices=True)))
    whole = rows.join(side, "digest", "left").join(side.select(
        F.col("digest").alias("other"), F.col("license").alias("with_notices")), "other", "left"
    ).withColumn("license", F.coalesce("license", "with_notices"))
    lines = F.explode_outer(F.array_distinct(F.split("text", "\n", -1)))
    found = whole.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "key", "digest", "license", lines.alias("line"))
    named = found.join(side.select(
        F.col("digest").alias("of_line"), F.col("license").alias("notice")),
        digest(F.col("line")) == F.col("of_line"), "left")
    return named.groupBy("row").agg(
        F.first("key").alias(key), F.first("digest").alias("digest"),
        F.first("license").alias("license"),
        F.array_sort(F.collect_set("notice")).alias("notices")).drop("row")
