"""Packing documents into windows by non-negative least squares.

1. Every document is tokenised once; its ids are written to the shared folder.
2. A document becomes full windows and one remainder.  The histogram of piece lengths has
   at most `window` rows and is all that reaches the driver.
3. Shallow combinations of up to three lengths that fill a window are enumerated, and
   non-negative least squares finds how often to repeat each so that the histogram is
   used up.  The counts are rounded down; what is left is packed greedily, longest first,
   cutting a piece where nothing fits.  The last, short rest is laid into sequences whose
   sizes are powers of two, which need no padding.
4. The plan says for each length which ranks go to which sequences.  Pieces are ranked per
   length in salted buckets, so no length is sorted in one task, and joined to the plan,
   whose number of rows is bounded by the window.

Defined results: a null or empty text has the end id alone; rows are packed one by one,
also repeated ones and rows with equal or null keys; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import wordbpe
from playlog.llm.common import lean, shards, slices, staged, text_of

WINDOW = 4096
#: Third lengths tried for each pair of a triple, and rounds of the least-squares solver.
THIRDS = 8
ROUNDS = 400


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of present lengths that sum to `window`.

    All pairs, and for each longest length the triples with the THIRDS most frequent
    second lengths: at most window * (THIRDS + 1) rows.
    """
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    often = lengths[np.argsort(-counts, kind="stable")]
    out = set()
    for a in lengths.tolist():
        rest = window - a
        if rest <= 0:
            continue
        if rest <= a and have[rest]:
            out.add((a, rest, 0))
        tried = 0
        for b in often.tolist():
            c = rest - b
            if c > 0 and have[c]:
                out.add(tuple(sorted((a, b, c), reverse=True)))
                tried += 1
                if tried == THIRDS:
                    break
    return np.array(sorted(out, reverse=True), np.int64).reshape(-1, 3)


def least_squares(combos: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |A x - goal|, A's columns counting the lengths of a combination.
    Accelerated projected gradient; `goal` is the histogram by length."""
    n = len(combos)
    if not n:
        return np.zeros(0)
    used = combos > 0
    flat = combos[used]
    owner = np.broadcast_to(np.arange(n)[:, None], combos.shape)[used]
    apply = lambda x: np.bincount(flat, x[owner], minlength=len(goal))
    back = lambda y: np.bincount(owner, y[flat], minlength=n)
    #: no eigenvalue of A'A exceeds its largest row sum
    step = 1.0 / max(1.0, back(apply(np.ones(n))).max())
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(ROUNDS):
        new = np.maximum(0.0, z - step * back(apply(z) - goal))
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z = new + (was - 1) / t * (new - x)
        x = new
    return x


class Stock:
    """Pieces still to be packed, in equal bundles: length -> (piece length, first rank,
    start within the piece)."""

    def __init__(self):
        self.by, self.lengths, self.total = {}, [], 0

    def put(self, length: int, bundle: tuple) -> None:
        if length:
            if length not in self.by:
                self.by[length] = []
                bisect.insort(self.lengths, length)
            self.by[length].append(bundle)
            self.total += length

    def take(self, length: int) -> tuple:
        bundle = self.by[length].pop()
        if not self.by[length]:
            del self.by[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))
        self.total -= length
        return bundle

    def fill(self, space: int) -> list[tuple[int, tuple]]:
        """Bundles that fill `space`: the longest that fits, again and again; where nothing
        fits, the shortest is cut and its rest goes back."""
        parts = []
        while space:
            i = bisect.bisect_right(self.lengths, space)
            length = self.lengths[i - 1] if i else self.lengths[0]
            piece, first, start = self.take(length)
            used = min(length, space)
            self.put(length - used, (piece, first, start + used))
            parts.append((used, (piece, first, start)))
            space -= used
        return parts


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """Rows (piece length, first rank, how many, start, length, first sequence, offset): the
    part [start, start + length) of the piece of rank `first rank + i` lies at `offset` of
    sequence `first sequence + i`.  And the number of sequences."""
    slots, sequences = [], 0

    def emit(parts: list[tuple[int, tuple]], n: int) -> None:
        nonlocal sequences
        offset = 0
        for length, (piece, first, start) in parts:
            slots.append((piece, first, n, start, length, sequences, offset))
            offset += length
        sequences += n

    next_rank = dict.fromkeys(histogram, 0)
    left = {k: v for k, v in histogram.items() if v > 0}
    if window in left:
        n = left.pop(window)
        emit([(window, (window, 0, 0))], n)
    lengths = np.array(sorted(left), np.int64)
    counts = np.array([left[k] for k in lengths.tolist()], np.int64)
    combos = combinations(lengths, counts, window)
    goal = np.zeros(window + 1)
    goal[lengths] = counts
    times = np.floor(least_squares(combos, goal) + 1e-9).astype(np.int64)
    for k in np.argsort(-times, kind="stable").tolist():
        parts = [x for x in combos[k].tolist() if x]
        n = min([int(times[k]), *(left[x] // parts.count(x) for x in set(parts))])
        if n <= 0:
            continue
        row = []
        for x in parts:
            row.append((x, (x, next_rank[x], 0)))
            next_rank[x] += n
            left[x] -= n
        emit(row, n)

    #: The rest in bundles of equal ranks, of the largest power of two first; what is left of
    #: one size is halved into the next.  Steps grow with the lengths and the logarithm of
    #: the counts, not with the counts.
    stock = Stock()
    size = 1 << max(0, max(left.values(), default=0).bit_length() - 4)
    while size:
        for x, n in left.items():
            for _ in range(n // size):
                stock.put(x, (x, next_rank[x], 0))
                next_rank[x] += size
            left[x] = n % size
        while stock.total >= window:
            emit(stock.fill(window), size)
        if size > 1:
            halves = [(x, bundle) for x, bundles in stock.by.items() for bundle in bundles]
            for x, (piece, first, start) in halves:
                stock.put(x, (piece, first + size // 2, start))
        size //= 2
    for bit in reversed(range(window.bit_length())):
        if stock.total & (1 << bit):
            emit(stock.fill(1 << bit), 1)
    return slots, sequences


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, key: str, text: str) -> DataFrame:
    """row (unique), the key, n and ids (little-endian unsigned 32-bit, end id included)."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        bpe = wordbpe.load(vocabulary)
        try:
            for b in slices(batches):
                ids = [bpe.encode(t.as_py()) + end for t in b.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["row", "key", "n", "ids"])
        finally:
            bpe.forget()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"),
                       text_of(text).alias("text"))
    return rows.mapInArrow(lean(encode), f"row long, key {kind}, n long, ids binary")


def pack(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id",
         text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per piece: key, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = staged(tokenised(docs, vocabulary, end_id, key, text), "packing")
    pieces = tokens.select("row", "n").select(
        "row", F.expr(f"explode(sequence(0L, n - 1, {window}L))").alias("start"), "n"
    ).select("row", "start", F.expr(f"least({window}L, n - start)").alias("size"))
    #: at most `window` rows
    histogram = {r["size"]: r["count"] for r in pieces.groupBy("size").count().collect()}
    slots, _ = plan(histogram, window)
    plan_rows = spark.createDataFrame(
        [tuple(map(int, s)) for s in slots],
        T.StructType([T.StructField(c, T.LongType()) for c in (
            "size", "first", "times", "part_start", "length", "first_sequence", "offset")]))

    salted = pieces.withColumn("salt", F.expr(f"pmod(xxhash64(row), {shards(spark)})"))
    before = salted.groupBy("size", "salt").count().selectExpr(
        "size", "salt", "coalesce(sum(count) OVER (PARTITION BY size ORDER BY salt "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    ranked = salted.withColumn("nth", F.expr(
        "row_number() OVER (PARTITION BY size, salt ORDER BY row, start) - 1")).join(
        before, ["size", "salt"]).withColumn("rank", F.col("nth") + F.col("before"))
    #: the plan's rows are bounded by the window, not by the corpus
    placed = ranked.join(F.broadcast(plan_rows), "size").where(
        "rank >= first AND rank < first + times").select(
        "row", (F.col("start") + F.col("part_start")).alias("start"), "length",
        (F.col("first_sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
    return tokens.join(placed, "row").select(
        F.col("key").alias(key), "start", "length",
        F.expr("substring(ids, cast(4 * start + 1 AS int), cast(4 * length AS int))").alias("ids"),
        F.col("n").alias("doc_tokens"), "sequence_id", "offset")


@functools.cache
def padding(size: int, window: int = WINDOW) -> int:
    """Padding of a sequence of `size` ids: none at a power of two."""
    return 0 if size & (size - 1) == 0 else window - size
