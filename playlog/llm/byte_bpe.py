"""Byte-level BPE: overlapping chunk encoding, and decoding.

Texts of up to `chunk` code points are one chunk.  A longer text is cut into windows of
`chunk` code points plus `overlap`, which are pre-tokenised in parallel.  The pattern looks
behind nowhere, so two pre-tokenisations that share one boundary agree from there on: the
first boundary that neighbouring windows share in their overlap is where they are stitched.
The regions between stitches are then split into pieces and encoded in parallel, and a
text's ids are its regions' ids in order.  A text with a joint that does not resynchronise
(a piece longer than the overlap) is pre-tokenised whole, as a short one is.  Decoding
concatenates the raw bytes of the ids.

Defined results: a null text counts as empty (no ids); repeated rows and rows with equal
keys are encoded one by one; strings of special tokens are ordinary text; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import slices, text_of
from playlog.llm.wordbpe import Words

CHUNK = 32_768
OVERLAP = 1_024


class ByteBpe:
    """Pre-tokenising, encoding and decoding with one file of ranks."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        ranks = {raw: i for i, raw in enumerate_ranks(path)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.ids = Words(lambda piece: np.array(
            self.encoding._encode_single_piece(piece), "<u4").tobytes())

    def encode(self, text: str, start: int = 0, end: int | None = None) -> bytes:
        """Ids (little-endian unsigned 32-bit) of the pieces that begin in [start, end).
        `start` has to be a boundary; text beyond `end` is only looked at."""
        if end is None:
            return b"".join(map(self.ids.__getitem__, self.pattern.findall(text, start)))
        pieces = []
        for m in self.pattern.finditer(text, start):
            if m.start() >= end:
                break
            pieces.append(m[0])
        return b"".join(map(self.ids.__getitem__, pieces))

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]


def enumerate_ranks(path: str):
    with open(path, "rb") as f:
        for a, b in map(bytes.split, f):
            yield int(b), base64.b64decode(a)


@functools.lru_cache(maxsize=2)
def raw_bytes(path: str) -> dict[int, bytes]:
    """What decoding needs: each id's bytes."""
    return dict(enumerate_ranks(path))


def decoded(ids: bytes, of: dict[int, bytes]) -> bytes:
    return b"".join(map(of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def stitches(chunks: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Per text (digest `h`): the code points where its regions begin, or [0] if a joint
    does not resynchronise.  `chunks` has h, k (place of the window), last, window."""
    schema = pa.schema([("h", pa.binary()), ("k", pa.int64()), ("head", pa.list_(pa.int64())),
                        ("tail", pa.list_(pa.int64()))])

    def ends(batches):
        bpe = load(ranks, pattern)
        for b in batches:
            rows = []
            for h, k, last, window in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = bpe.boundaries(window)
                sure = found if last else found[:-2]  # the cut end may change the last ones
                rows.append((h, k, [p + k * chunk for p in sure if p < overlap],
                             [p + k * chunk for p in sure if p >= chunk]))
            yield _batch(rows, schema)

    joints = (chunks.mapInArrow(ends, "h binary, k long, head array<long>, tail array<long>")
              .withColumn("before", F.expr("lag(tail) OVER (PARTITION BY h ORDER BY k)"))
              .withColumn("at", F.expr("CASE WHEN k = 0 THEN 0L ELSE "
                                       "array_min(array_intersect(head, before)) END")))
    return joints.groupBy("h").agg(F.expr(
        "CASE WHEN bool_or(at IS NULL) THEN array(0L) ELSE sort_array(collect_list(at)) END"
    ).alias("starts"))


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP, round_trip: bool = False) -> DataFrame:
    """Per row of `docs`: its key and `ids` (binary, little-endian unsigned 32-bit); with
    `round_trip` also `raw`, the bytes that the ids decode to, made by the same worker."""
    if not 4 <= overlap <= chunk:
        raise ValueError("overlap must lie between 4 and chunk")
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))

    more = ", raw binary" if round_trip else ""

    def columns(ids: list[bytes]) -> dict[str, pa.Array]:
        out = {"ids": pa.array(ids, pa.binary())}
        if round_trip:
            of = raw_bytes(ranks)
            out["raw"] = pa.array([decoded(x, of) for x in ids], pa.binary())
        return out

    def whole(batches):
        bpe = load(ranks, pattern)
        for b in slices(batches):
            yield pa.RecordBatch.from_pydict(
                {"key": b.column(0)} | columns([bpe.encode(t.as_py()) for t in b.column(1)]))

    short = rows.where(F.length("text") <= chunk).mapInArrow(
        whole, f"key {kind}, ids binary{more}")

    #: long texts, each different one once
    named = rows.where(F.length("text") > chunk).withColumn("h", F.expr("unhex(sha2(text, 256))"))
    texts = named.select("h", "text").dropDuplicates(["h"])
    chunks = texts.select(
        "h", "text", F.expr(f"explode(sequence(0L, (length(text) - 1) DIV {chunk}))").alias("k")
    ).select("h", "k", F.expr(f"(k + 1) * {chunk} >= length(text)").alias("last"),
             F.expr(f"substring(text, cast(k * {chunk} + 1 AS int), {chunk + overlap})")
             .alias("window")).repartition("h", "k")
    starts = stitches(chunks, ranks, pattern, chunk, overlap)
    #: each region with a little text beyond it, as white space looks one character ahead
    regions = texts.join(starts, "h").select(
        "h", "text", "starts", F.expr("posexplode(starts)").alias("i", "start")
    ).withColumn("end", F.expr("coalesce(get(starts, i + 1), cast(length(text) AS long))")).select(
        "h", "i", F.expr("end - start").alias("size"),
        F.expr("substring(text, cast(start + 1 AS int), cast(end - start + 2 AS int))")
        .alias("window")).repartition("h", "i")

    def pieces(batches):
        bpe = load(ranks, pattern)
        for b in slices(batches):
            ids = pa.array([bpe.encode(w, 0, n) for n, w in zip(
                b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids], ["h", "i", "ids"])

    def joined(k, t):  # one text's regions
        order = np.argsort(t.column("i").to_numpy())
        ids = b"".join(t.column("ids")[int(j)].as_py() for j in order)
        return pa.table({"h": pa.array([k[0].as_py()], pa.binary())} | columns([ids]))

    encoded = regions.mapInArrow(pieces, "h binary, i int, ids binary").groupBy("h").applyInArrow(
        joined, f"h binary, ids binary{more}")
    long = named.select("key", "h").join(encoded, "h").drop("h")
    return short.unionByName(long).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: str, key: str = "doc_id") -> DataFrame:
    """Per row: its key, `ids` and the `raw` bytes that they stand for."""
    kind = encoded.schema[key].dataType.simpleString()

    def raw(batches):
        of = raw_bytes(ranks)
        for b in slices(batches):
            out = pa.array([decoded(x.as_py(), of) for x in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), out],
                                             ["key", "ids", "raw"])

    return encoded.select(F.col(key).alias("key"), "ids").mapInArrow(
        raw, f"key {kind}, ids binary, raw binary").withColumnRenamed("key", key)


def pattern() -> str:
    """The public pattern that splits text before the merges."""
    import public_tokenizers

    return public_tokenizers.PATTERN
