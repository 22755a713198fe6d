"""Secret scan with corpus-wide ownership frequency.

Every whole text is searched for the base kinds and for opaque candidates (long random-
looking strings of 24 characters or more, of any length, that no base kind covers).  Each found value is reduced to a digest, and
the digests are counted over the corpus by distinct owners and, if the table has a column of
repositories, by distinct repositories.  A value that many owners, or several owners in many
repositories, hold is a widely copied example; one held by few is a live-looking credential.  A
value of one owner is live however many documents or repositories hold it, and a document is no
repository: copies of a document say nothing about who holds a value.  Opaque candidates become
spans only if they are live-looking; base spans always stay and carry the class.

The aggregation has partial sums per task; the way back from the digests is salted, so a
value found in a third of all documents does not meet in one task.  Nothing is broadcast, as
the digests grow with the corpus.

Defined results: a null text counts as empty (no spans); repeated rows are searched one by
one and count as one holder if their key is equal; rows with a null repository or owner count as
held by one unnamed; an empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import lean, slices, staged, text_of

#: Kinds in their order, pattern, value group and least length of that group.
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: An equal set of hex matches, found without stopping at every short run.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
OPAQUE = "opaque"
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?![A-Za-z0-9+/_-])", re.A)
ENTROPY = 3.5
#: A value with more owners than this, or of several owners with more repositories than this, is
#: a widely copied example.
OWNERS = 2
REPOSITORIES = 50
SALTS = 16

_SPAN = "struct<kind:string,start:long,end:long,digest:binary>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), by start, then kind as listed."""
    found = []
    for kind, pattern, group, least in KINDS:
        if kind == "assign" and not _KEYWORD.search(text):
            continue
        if kind == "hex":
            pattern = _LONG_HEX
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((kind, m.start(), m.end(), m[group]))
    order = {k[0]: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def _random_looking(value: str) -> bool:
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in map(value.count, set(value))) >= ENTROPY


def candidates(text: str, base: list[tuple]) -> list[tuple[str, int, int, str]]:
    """Opaque strings that no base span touches."""
    out, i = [], 0
    spans = sorted((s[1], s[2]) for s in base)
    for m in _OPAQUE.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if (i == len(spans) or spans[i][0] >= m.end()) and _random_looking(m[0]):
            out.append((OPAQUE, m.start(), m.end(), m[0]))
    return out


def found(docs: DataFrame, key: str, text: str, repository: str | None, owner: str) -> DataFrame:
    """row (unique), key, repository (null if no column), owner and the array of spans of each
    document."""
    held_in = F.lit(None).cast("long") if repository is None else docs[repository]
    kinds = {c: "bigint" if c is None else docs.schema[c].dataType.simpleString()
             for c in (key, repository, owner)}
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("digest", pa.binary())])

    def search(batches):
        for b in slices(batches):
            out = []
            for t in b.column(4):
                t = t.as_py()
                base = base_spans(t)
                out.append([{"kind": k, "start": s, "end": e,
                             "digest": hashlib.sha256(v.encode()).digest()[:16]}
                            for k, s, e, v in base + candidates(t, base)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(out, pa.list_(span))],
                ["row", "key", "repository", "owner", "found"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"),
                       held_in.alias("repository"), docs[owner].alias("owner"),
                       text_of(text).alias("text"))
    return rows.mapInArrow(lean(search), f"row long, key {kinds[key]}, repository {kinds[repository]}, "
                                   f"owner {kinds[owner]}, found array<{_SPAN}>")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
         repository: str | None = None, owner: str = "source", owners: int = OWNERS,
         repositories: int = REPOSITORIES) -> DataFrame:
    """Per row of `docs`: key and `spans`, an array of (start, kind, end, n_owners,
    n_repositories, live) by start and kind; base spans all, opaque ones if live.  Without a
    column of repositories n_repositories is null and the owners alone decide."""
    rows = staged(found(docs, key, text, repository, owner), "secret-scan")
    single = rows.where(F.size("found") > 0).select(
        "row", "repository", "owner", F.inline("found"))
    #: distinct holders, counted in two steps so that a hot value is spread by its holders
    held = lambda c, n: single.select(
        "digest", F.coalesce(F.xxhash64(c), F.lit(0)).alias("h")
    ).distinct().groupBy("digest").agg(F.count("*").alias(n))
    counts = held("owner", "n_owners")
    few = F.col("n_owners") <= owners
    if repository is None:
        counts = counts.withColumn("n_repositories", F.lit(None).cast("long"))
    else:
        counts = counts.join(held("repository", "n_repositories"), "digest")
        few &= (F.col("n_owners") == 1) | (F.col("n_repositories") <= repositories)
    counts = counts.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    order = F.expr("CASE kind " + " ".join(
        f"WHEN '{k[0]}' THEN {i}" for i, k in enumerate(KINDS)) + f" ELSE {len(KINDS)} END")
    judged = single.drop("owner", "repository").withColumn(
        "salt", F.expr(f"cast(pmod(xxhash64(row, start), {SALTS}) AS int)")
    ).join(counts.hint("merge"), ["digest", "salt"]).withColumn(
        "live", few).where((F.col("kind") != OPAQUE) | F.col("live")).withColumn("order", order)
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", "order", "end", "kind", "n_owners", "n_repositories", "live"))).alias("spans"))
    return rows.select("row", "key").join(per_row.hint("merge"), "row", "left").select(
        F.col("key").alias(key), F.expr("coalesce(spans, array())").alias("spans"))


def redact(text, spans, mask: str = "[secret]"):
    """Column: `text` (null: empty) with the live spans, overlaps merged, replaced by `mask`."""
    whole = F.coalesce(text, F.lit(""))
    return F.pandas_udf(_redacted, "string")(whole, F.filter(spans, lambda s: s["live"]), F.lit(mask))


def _redacted(text, spans, mask):
    import pandas as pd

    def one(t, found, mask):
        out, at = [], 0
        for s in [] if found is None else found:
            if s["end"] > at:
                if s["start"] >= at:
                    out += [t[at:s["start"]], mask]
                at = s["end"]
        return "".join([*out, t[at:]])

    return pd.Series([one(*x) for x in zip(text, spans, mask, strict=True)], dtype=object)
