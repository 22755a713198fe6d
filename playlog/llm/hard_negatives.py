"""Hard-negative mining by an exact matrix product in a residue number system.

Components become whole numbers, floor(scale * x).  An anchor's positives are the first
rows of its label by inner product; the negatives of a positive are the first rows of
other labels whose score lies between two shares of the positive's.

1. Valid rows with whole components are written once.  The largest component bounds every
   score, and the bound says how many of `PRIMES` are needed.
2. Anchors are dealt evenly to blocks of at most `BLOCK` or so.  One block at a time goes
   to every task, and all rows are read against it: a stated query set, in blocks.
3. A task multiplies rows and anchors modulo each prime in float32.  Residues are at most
   half a prime, so `CHUNK` products add up to less than 2^24 and float32 is exact; longer
   vectors take several chunks.  Chinese remaindering in mixed radix with signed digits
   gives the exact signed scores.
4. First pass: a task keeps the best rows of the same label per anchor, windows pick the
   positives.  Second pass: with the positives known, a task keeps the best rows within
   each positive's band, windows pick the negatives.

Defined results: rows with a null label, a null vector, or a null or non-finite component
take no part, whatever the anchor condition says of them.  Equal scores go by key, a null
key first.  Every row is a row of its own; an anchor's other rows are those of another
key (a null key differs from all), so copies of its own key are neither positives nor
negatives, and a key that occurs twice among the anchors is mined twice.  Shorter vectors
count as filled up with zeros.  A row without a key is no anchor.  Components so large that a
score may reach `SCORES` raise ValueError.  An empty table, or one without anchors, gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import ranked, slices, staged

#: The greatest primes below 1024: residues of at most 510 in absolute value.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
CHUNK = (2 ** 24 - 1) // 510 ** 2
#: Anchors of a block; anchors and rows multiplied at a time.
BLOCK = 16384
ANCHORS = 256
ROWS = 4096
LOWEST = -2 ** 63
#: Scores stay below this, so that they can be multiplied by per cents.
SCORES = 2 ** 56


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as distinguish the whole numbers from -bound to bound."""
    if bound >= SCORES:
        raise ValueError(f"scores may reach {bound}, the greatest allowed is {SCORES - 1}")
    return next(PRIMES[:n] for n in range(1, len(PRIMES) + 1) if math.prod(PRIMES[:n]) > 2 * bound)


def residues(whole: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """float32 residues modulo each prime, between -(p - 1) / 2 and (p - 1) / 2."""
    return [((whole + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def _signed(x: np.ndarray, p: int) -> np.ndarray:
    return (x + p // 2) % p - p // 2


def products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact int64 inner products of the rows of `a` with those of `b`, given as residues."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        width, total = a[i].shape[1], None
        for at in range(0, max(width, 1), CHUNK):
            part = _signed((a[i][:, at:at + CHUNK] @ b[i][:, at:at + CHUNK].T).astype(np.int32), p)
            total = part if total is None else total + part
        digit = total
        for q, d in zip(primes, digits):          # mixed radix: remove what is known, divide
            digit = _signed((digit - d) * pow(q, -1, p), p)
        digits.append(_signed(digit, p))
    score = digits[-1].astype(np.int64)
    for q, d in zip(primes[-2::-1], digits[-2::-1]):
        score = score * q + d
    return score


def top(scores: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest scores from `least[row]` up, equal ones by column."""
    if scores.shape[1] > k:
        kth = np.partition(scores, -k, axis=1)[:, -k]
        least = np.maximum(least, kth)
    rows, columns = np.nonzero((scores >= least[:, None]) & (scores > LOWEST))
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    starts = np.searchsorted(rows, np.arange(len(scores)))
    near = np.arange(len(rows)) - starts[rows] < k
    return rows[near], columns[near]


class Best:
    """The k highest (score, key) per group over a task's batches."""

    def __init__(self, groups: int, k: int):
        self.groups, self.k = groups, k
        self.group = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.null = np.empty(0, bool)
        self.key = np.empty(0, np.int64)
        self.least = np.full(groups, LOWEST, np.int64)

    def add(self, group, score, null, key) -> None:
        if not len(group):
            return
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        null, key = np.concatenate([self.null, null]), np.concatenate([self.key, key])
        order = np.lexsort((key, ~null, -score, group))
        group = group[order]
        starts = np.searchsorted(group, np.arange(self.groups))
        place = np.arange(len(group)) - starts[group]
        near = place < self.k
        self.group, order = group[near], order[near]
        self.score, self.null, self.key = score[order], null[order], key[order]
        last = place[near] == self.k - 1
        self.least[self.group[last]] = self.score[last]


class Rows:
    """A batch of rows in key order, a null key first, with their residues."""

    def __init__(self, batch: pa.RecordBatch, width: int, primes: tuple[int, ...]):
        null = batch["key"].is_null().to_numpy(zero_copy_only=False)
        key = batch["key"].fill_null(0).to_numpy()
        order = np.lexsort((key, ~null))
        self.null, self.key = null[order], key[order]
        self.label = batch["label"].to_numpy()[order]
        self.whole = residues(filled(batch["whole"], width)[order], primes)


def filled(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix, shorter ones filled up with zeros."""
    held = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (held == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < held[:, None]] = flat
    return out


class Anchors:
    """A block of anchors as the tasks get it."""

    def __init__(self, table: pa.Table, width: int, primes: tuple[int, ...]):
        self.key, self.label = table["key"].to_numpy(), table["label"].to_numpy()
        self.whole = residues(filled(table["whole"].combine_chunks(), width), primes)
        self.width, self.primes = width, primes
        self.rows_at_a_time, self.anchors_at_a_time = ROWS, ANCHORS

    def pairs(self, batches):
        """For each part of the block and of the rows: the part (a slice), the rows, the scores,
        whether labels are equal, and whether the row is another than the anchor."""
        for b in slices(batches, self.rows_at_a_time):
            rows = Rows(b, self.width, self.primes)
            for at in range(0, len(self.key), self.anchors_at_a_time):
                part = slice(at, min(at + self.anchors_at_a_time, len(self.key)))
                scores = products([m[part] for m in self.whole], rows.whole, self.primes)
                alike = self.label[part, None] == rows.label[None, :]
                other = (self.key[part, None] != rows.key[None, :]) | rows.null
                yield part, rows, scores, alike, other


def _batch(best: Best, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(best.group), pa.array(best.key, mask=best.null), pa.array(best.score)], names=names)


def _positives(anchors, k: int):
    def run(batches):
        block = anchors.value
        best = Best(len(block.key), k)
        for part, rows, scores, alike, other in block.pairs(batches):
            masked = np.where(alike & other, scores, LOWEST)
            i, j = top(masked, k, best.least[part])
            best.add(i + part.start, scores[i, j], rows.null[j], rows.key[j])
        yield _batch(best, ["anchor", "positive", "positive_score"])
    return run


def _negatives(anchors, bands, k: int):
    """`bands`: arrays (anchor, least, most) of the positives, in anchor order."""
    def run(batches):
        block, (anchor, least, most) = anchors.value, bands.value
        best = Best(len(anchor), k)
        for part, rows, scores, alike, other in block.pairs(batches):
            a, z = np.searchsorted(anchor, [part.start, part.stop])
            differs = other & ~alike
            for nth in range(a, z, block.anchors_at_a_time):
                of = slice(nth, min(nth + block.anchors_at_a_time, z))
                own = anchor[of] - part.start
                inside = differs[own] & (scores[own] <= most[of, None])
                masked = np.where(inside, scores[own], LOWEST)
                i, j = top(masked, k, np.maximum(least[of], best.least[of]))
                best.add(i + nth, masked[i, j], rows.null[j], rows.key[j])
        yield _batch(best, ["band", "negative", "negative_score"])
    return run


def whole_rows(rows: DataFrame, anchor: Column, key: str, label: str, vector: str,
               scale: int) -> DataFrame:
    """(key, label, whole, anchor) of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
        .alias("whole"), F.coalesce(anchor & F.col(key).isNotNull(), F.lit(False)).alias("anchor"))


def mine(rows: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label",
         vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` says which rows are anchors; a negative's score in per cent of its positive's
    lies between `low` and `high`.
    """
    spark = rows.sparkSession
    held = staged(whole_rows(rows, anchor, key, label, vector, scale), "whole-vectors")
    highest, lowest, width, n = held.agg(
        F.max(F.array_max("whole")), F.min(F.array_min("whole")), F.max(F.size("whole")),
        F.count_if("anchor")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, " \
             "positive_score long, negative_score long"
    mined = spark.createDataFrame([], schema)
    if not n:
        return mined
    primes = primes_for(width * max(highest or 0, -(lowest or 0)) ** 2)
    blocks = -(-n // block)
    asked = staged(held.where("anchor").drop("anchor").repartition(blocks).withColumn(
        "block", F.spark_partition_id()), "anchors")
    for b in range(blocks):
        table = asked.where(F.col("block") == b).drop("block").toArrow()
        if not len(table):
            continue
        shared = spark.sparkContext.broadcast(Anchors(table, width, primes))
        near = held.select("key", "label", "whole")
        best = ranked(near.mapInArrow(_positives(shared, positives),
                                      "anchor long, positive long, positive_score long"),
                      ["anchor"], [F.desc("positive_score"), F.asc("positive")], positives)
        chosen = best.orderBy("anchor", "rank").drop("rank").toArrow()   # block x positives rows
        of, score = chosen["anchor"].to_numpy(), chosen["positive_score"].to_numpy()
        # 100 * negative between low * positive and high * positive, in whole numbers
        bands = spark.sparkContext.broadcast((of, -(-low * score // 100), high * score // 100))
        found = ranked(near.mapInArrow(_negatives(shared, bands, negatives),
                                       "band long, negative long, negative_score long"),
                       ["band"], [F.desc("negative_score"), F.asc("negative")], negatives)
        named = pa.table({
            "band": pa.array(np.arange(len(of))), "anchor_id": table["key"].take(pa.array(of)),
            "positive_id": chosen["positive"], "positive_score": chosen["positive_score"]})
        mined = mined.union(found.join(F.broadcast(spark.createDataFrame(named)), "band").select(
            "anchor_id", "positive_id", "rank", F.col("negative").alias("negative_id"),
            "positive_score", "negative_score"))
    return mined
