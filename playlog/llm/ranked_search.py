"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Documents are scored for each item with a saturating term frequency, a length norm and a
rarity weight, all in 64-bit integers (see `weight` and `_impacts`).

1. The items' distinct terms are the vocabulary.  Items are dealt to blocks so that a
   block's terms take about `BLOCK_BYTES`; a block's vocabulary goes to every task.
2. One text pass per block writes, for every document, its number of terms and its
   frequencies of vocabulary terms.  N, L and the document frequencies are aggregates of
   that table.
3. Every task takes slices of documents, sorts a slice's postings by term and evaluates
   each item term at a time, rarest first.  A term's bound is its weight times the largest
   impact it has in the slice.  Once the bounds of the terms left are below the k-th
   partial score (of the slice, or of what the task has found before), no document without
   an accumulator can be among the first k, so no new accumulators are made; the
   existing ones are still updated exactly.  A task keeps k documents per item.
4. The tasks' documents are ranked per item by windows.

Defined results: a null text has no terms; documents without terms are not counted in N
and never returned; an item without terms gets no rows.  Every row of the documents is a
document of its own, also if ids repeat or are null; equal scores go by id, null first.
Rows that share an item id (or have none) are one item with the terms of all.  Whole
texts are read, long ones tokenised `PIECE` bytes at a time.  An empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from playlog.llm.common import ranked, slices, staged

#: UTF-8 bytes of a term: digits, letters and everything beyond ASCII; A-Z are folded.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32
              for b in range(256))
PIECE = 1 << 20
BLOCK_BYTES = 8 << 20
#: What a term costs besides its bytes, in the driver's list and a task's dictionary.
TERM_OVERHEAD = 64
SLICE = 4096


def words(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some `PIECE` bytes at a time."""
    text, at = raw.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def weight(n_docs: int, df: int) -> int:
    """Rarity of a term: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each item."""
    def run(batches):
        for b in slices(batches):
            ids, terms = [], []
            for i, raw in enumerate(b[1].cast(pa.binary()).to_pylist()):
                distinct = set().union(*words(raw or b""))
                ids += [i] * len(distinct)
                terms += distinct
            yield pa.RecordBatch.from_arrays(
                [b[0].take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary()).cast(pa.utf8())],
                names=["item", "term"])

    source = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    kind = source.schema["item"].dataType
    return source.mapInArrow(run, T.StructType([
        T.StructField("item", kind), T.StructField("term", T.StringType())])).distinct()


def postings(docs: DataFrame, vocabulary, key: str, text: str) -> DataFrame:
    """(key, n, ids, tfs) of each document that has terms: how many, and the frequencies of
    vocabulary terms.  `vocabulary` is a broadcast dictionary of UTF-8 terms to numbers."""
    def run(batches):
        known = vocabulary.value.get
        for b in slices(batches):
            rows, counts, ends, ids, tfs = [], [], [0], [], []
            for i, raw in enumerate(b[1].cast(pa.binary())):
                n, found = 0, Counter()
                for piece in words(raw.as_py() or b""):
                    n += len(piece)
                    found.update(map(known, piece))
                if n:
                    found.pop(None, None)
                    rows.append(i)
                    counts.append(n)
                    ids += found.keys()
                    tfs += found.values()
                    ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b[0].take(pa.array(rows, pa.int64())), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                names=["key", "n", "ids", "tfs"])

    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, T.StructType([
        T.StructField("key", source.schema["key"].dataType), T.StructField("n", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("tfs", T.ArrayType(T.LongType()))]))


@dataclass
class Plan:
    """What a block of items needs to be evaluated: per item its terms, rarest first, and
    their weights; the corpus counts."""
    items: list
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    n_docs: int
    n_terms: int
    vocabulary: int


def _impacts(tf: np.ndarray, n: np.ndarray, plan: Plan) -> np.ndarray:
    m = 100 - 50 + (50 * n * plan.n_docs) // plan.n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Slice:
    """A slice's postings by term, with their impacts and each term's largest impact."""

    def __init__(self, batch: pa.RecordBatch, plan: Plan):
        self.size, self.keys = len(batch), batch.column("key")
        ids, tfs = batch.column("ids"), batch.column("tfs")
        held = np.diff(ids.offsets.to_numpy())
        rows = np.repeat(np.arange(self.size), held)
        terms = ids.flatten().to_numpy()
        n = batch.column("n").to_numpy()
        impacts = _impacts(tfs.flatten().to_numpy(), n[rows], plan)
        by_term = np.argsort(terms, kind="stable")
        self.rows, self.impacts = rows[by_term], impacts[by_term]
        df = np.bincount(terms, minlength=plan.vocabulary)
        self.ends = np.concatenate([[0], np.cumsum(df)])
        self.most = np.zeros(plan.vocabulary, np.int64)
        there = np.flatnonzero(df)
        if len(there):
            self.most[there] = np.maximum.reduceat(self.impacts, self.ends[there])

    def scores(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> np.ndarray:
        """Accumulators of one item, term at a time; exact for every document that can reach
        `least` and the slice's k-th score."""
        acc = np.zeros(self.size, np.int64)
        bounds = weights * self.most[terms]
        left, done, alive = int(bounds.sum()), 0, None
        for t, w, bound in zip(terms.tolist(), weights.tolist(), bounds.tolist()):
            if not bound:
                continue
            if alive is None:
                kth = least
                if left < done and self.size > k:   # no partial score is over `done`
                    kth = max(kth, int(np.partition(acc, -k)[-k]))
                if left < kth:
                    alive = acc > 0
                    if not alive.any():
                        break
            rows = self.rows[self.ends[t]:self.ends[t + 1]]
            gain = w * self.impacts[self.ends[t]:self.ends[t + 1]]
            if alive is not None:
                live = alive[rows]
                rows, gain = rows[live], gain[live]
            acc[rows] += gain
            left -= bound
            done += bound
        return acc


def first(scores: pa.Array, keys: pa.Array, k: int) -> tuple[pa.Array, pa.Array]:
    """The k highest scores, equal ones by key."""
    best = pc.sort_indices(
        pa.RecordBatch.from_arrays([scores, keys], names=["score", "key"]),
        sort_keys=[("score", "descending"), ("key", "ascending")], null_placement="at_start")[:k]
    return scores.take(best), keys.take(best)


def _evaluate(plan: Plan, k: int, item_type: pa.DataType):
    def run(batches):
        found: list = [None] * len(plan.items)
        for batch in slices(batches, SLICE):
            part = Slice(batch, plan)
            for i, (terms, weights) in enumerate(zip(plan.terms, plan.weights)):
                old = found[i]
                least = max(1, old[0][k - 1].as_py() if old and len(old[0]) == k else 1)
                acc = part.scores(terms, weights, k, least)
                hits = np.flatnonzero(acc >= least)
                if not len(hits):
                    continue
                scores, keys = pa.array(acc[hits]), part.keys.take(pa.array(hits))
                if old:
                    scores = pa.concat_arrays([old[0], scores])
                    keys = pa.concat_arrays([old[1], keys])
                found[i] = first(scores, keys, k)
        for item, got in zip(plan.items, found):
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(got[0]), item_type), got[1], got[0]],
                    names=["item", "key", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id",
           item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`item`, rank, `key`, score: each item's `k` highest documents with a score above 0."""
    spark = docs.sparkSession
    asked = staged(item_terms(items, item, text), "item-terms")
    size = asked.agg(F.sum(F.octet_length("term") + TERM_OVERHEAD)).first()[0] or 0
    blocks = size // block_bytes + 1
    kinds = T.StructType([T.StructField("item", asked.schema["item"].dataType),
                          T.StructField("key", docs.schema[key].dataType),
                          T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], kinds)
    for block in range(blocks if size else 0):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({r.term for r in rows}))}
        held = staged(postings(docs, spark.sparkContext.broadcast(vocabulary), key, text),
                      "item-postings")
        n_docs, n_terms = held.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = {r.t: r.n for r in held.select(F.explode("ids").alias("t")).groupBy("t").agg(
            F.count(F.lit(1)).alias("n")).collect()}
        of_item: dict = {}
        for r in rows:
            t = vocabulary[r.term.encode()]
            if t in df:
                of_item.setdefault(r.item, []).append((df[t], t))
        order = [sorted(ts) for ts in of_item.values()]
        plan = Plan(list(of_item), [np.array([t for _, t in ts]) for ts in order],
                    [np.array([weight(n_docs, n) for n, _ in ts], np.int64) for ts in order],
                    n_docs, n_terms, len(vocabulary))
        found = found.union(held.mapInArrow(
            _evaluate(plan, k, to_arrow_type(kinds["item"].dataType)), kinds))
    return ranked(found, ["item"], [F.desc("score"), F.asc("key")], k).select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
