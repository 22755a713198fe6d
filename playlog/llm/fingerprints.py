"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; the hash's top bits name one of `BINS` bins and a bin keeps
its smallest remaining value.  Empty bins are filled by optimal densification: bin i asks bins
chosen by a hash of (i, attempt), the same for every document, until one is not empty.  The
lowest `BITS` bits of each bin are packed into the fingerprint.  The likeness of two
fingerprints is the share of equal bins, corrected for the bins that agree by chance.

Defined results: a null text counts as empty; a text of fewer words than a shingle is one
shingle; texts without words have the fingerprint of zeros under its own mark, like each
other (1) and unlike all else (0); repeated rows are handled one by one; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm import shingles
from playlog.llm.common import shards, text_of

WORDS = 5
BINS = 256
BITS = 4
#: What an empty text's fingerprint consists of.
NONE = b""
_U = np.uint64


def bins(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(texts, BINS) densified values, and which texts have words."""
    own = shingles.shingles(texts, words)
    size = np.array([len(s) for s in own])
    out = np.full(len(texts) * BINS, 2**64 - 1, _U)
    h = np.concatenate(own)
    where = np.repeat(np.arange(len(texts)) * BINS, size) + (
        h >> _U(64 - BINS.bit_length() + 1)).astype(np.int64)
    #: the top bits no longer tell within a bin
    np.minimum.at(out, where, shingles.mix(h) >> _U(1))
    return densified(out.reshape(len(texts), BINS)), size > 0


def densified(values: np.ndarray) -> np.ndarray:
    empty = values == _U(2**64 - 1)
    out = values.copy()
    row, col = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    attempt = 0
    while len(row):  # only what is still empty; a text with one full bin takes the longest
        attempt += 1
        donor = (shingles.mix(np.arange(BINS, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(attempt))
                 % _U(BINS)).astype(np.int64)[col]
        found = ~empty[row, donor]
        out[row[found], col[found]] = values[row[found], donor[found]]
        row, col = row[~found], col[~found]
    return out


def fingerprints(texts: list[bytes], words: int = WORDS) -> list[bytes]:
    """Packed low bits, BINS * BITS / 8 bytes each; NONE for a text without words."""
    values, some = bins(texts, words)
    #: a value copied to many bins agrees by chance in each of them on its own
    values = shingles.mix(values ^ (np.arange(BINS, dtype=_U) * _U(0x9E3779B97F4A7C15)))
    low = (values & _U((1 << BITS) - 1)).astype(np.uint8).reshape(len(texts), -1, 8 // BITS)
    packed = np.bitwise_or.reduce(
        low << (np.arange(8 // BITS, dtype=np.uint8) * np.uint8(BITS)), axis=2)
    return [p.tobytes() if s else NONE for p, s in zip(packed, some.tolist(), strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of common shingles: equal bins less those equal by chance."""
    if NONE in (a, b):
        return float(a == b)
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    lanes = x.copy()
    for k in range(1, BITS):
        lanes |= x >> np.uint8(k)
    mark = np.uint8(sum(1 << k for k in range(0, 8, BITS)))
    equal = 1 - int(np.bitwise_count(lanes & mark).sum()) / BINS
    chance = 2.0 ** -BITS
    return min(1.0, max(0.0, (equal - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _blocks(docs: DataFrame, key: str, n: int) -> DataFrame:
    """`docs` with `block` (descending key ranges, 0 first) and `guest`: a block's first
    document also goes, as a guest, to the end of the block before it (of block 0: to the
    last), so that each document's successor lies in its own block.

    Only n - 1 bounds and one key per block reach the driver; n is the number of shuffle
    partitions."""
    ids = docs.where(F.col(key).isNotNull())
    bounds = sorted({b for b in ids.approxQuantile(
        key, [i / n for i in range(1, n)], 1 / (4 * n))}, reverse=True) if n > 1 else []
    block = F.lit(0)
    if bounds:
        cuts = F.array(*[F.lit(b) for b in bounds])
        block = F.when(F.col(key).isNull(), len(bounds)).otherwise(
            F.size(F.filter(cuts, lambda c: F.col(key) <= c)))
    dealt = docs.withColumn("block", block.cast("int"))
    heads = {r["block"]: r["head"] for r in dealt.groupBy("block").agg(
        F.max(key).alias("head")).collect()}
    order = sorted(heads)
    if not order:
        return dealt.withColumn("to", F.lit(None).cast("int"))
    of = lambda values: F.element_at(F.map_from_arrays(
        F.array(*map(F.lit, order)), F.array(*map(F.lit, values))), F.col("block"))
    is_head = F.col(key).eqNullSafe(of([heads[b] for b in order]))
    return dealt.withColumn("to", F.when(is_head, of([order[i - 1] for i in range(len(order))])))


def chained(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS
            ) -> DataFrame:
    """Per row of `docs`, in descending order of key: key, n_chars, `edited` text (see
    `edited`; after the last document the first follows), the fingerprints of text and
    edited text, and the likeness to the edited text's and to the next document's."""
    spark = docs.sparkSession
    n = shards(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))
    dealt = _blocks(rows, "key", n)
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("guest"))
    other = F.struct(F.col("to").alias("block"), F.lit(1).alias("guest"))
    placed = dealt.withColumn("at", F.explode(F.when(
        F.col("to").isNull(), F.array(own)).otherwise(F.array(own, other)))).select(
        "key", "text", F.col("at.block").alias("block"), F.col("at.guest").alias("guest"))
    sorted_ = placed.repartitionById(n, F.col("block")).sortWithinPartitions(
        "block", "guest", F.col("key").desc_nulls_last(), "text")
    out = pa.schema([("key", rows_type(docs, key)), ("n_chars", pa.int64()),
                     ("edited", pa.string()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64())])

    def chain(batches):
        #: the rows read; one stays until its successor is there
        waiting = []
        for b in batches:
            size = 0
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                waiting.append(r)
                size += len(r[1])
                if size > shingles.CHUNK:
                    yield from emit(waiting)
                    waiting, size = waiting[-1:], 0
            if len(waiting) > 1:
                yield from emit(waiting)
                waiting = waiting[-1:]

    def emit(rows):
        pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False)
                 if a[2] == b[2] and not a[3]]
        if not pairs:
            return
        changed = [edited(a[1], b[1]) for a, b in pairs]
        raw = [r[1].encode() for r in rows]
        of = dict(zip(map(id, rows), fingerprints(raw, words), strict=True))
        new = fingerprints([c.encode() for c in changed], words)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((
            [a[0] for a, _ in pairs], [len(a[1]) for a, _ in pairs], changed,
            [of[id(a)] for a, _ in pairs], new,
            [likeness(of[id(a)], e) for (a, _), e in zip(pairs, new, strict=True)],
            [likeness(of[id(a)], of[id(b)]) for a, b in pairs]), out, strict=True)], schema=out)

    return sorted_.mapInArrow(
        chain, f"key {kind}, n_chars long, edited string, fingerprint binary, "
               "edited_fingerprint binary, near_edited double, near_next double"
    ).withColumnRenamed("key", key)


def rows_type(docs: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[key].dataType)

