"""MinHash near-duplicates with b-bit signatures.

1. One pass over the texts: each document's distinct word shingles, `HASHES` minima, keys of
   bands of whole minima from the first of them, and all minima's low bits packed into longs.
2. Documents with equal shingle sets are one class; the rest works on one row per class.
3. Classes that share a band key are candidates.  In each bucket every class is paired with
   the hub, never all with all: the class whose buckets are largest in sum, which is the one
   that most copies stem from.
4. A pair goes on if its sizes allow the threshold and its collision-corrected similarity,
   estimated by counting equal low bits, is not far below it.
5. The pairs left are confirmed on full sets, made anew from the whole texts.
6. Components of the confirmed links; then each bucket in which several components meet is
   compared across components by low bits, in blocks.  A block names the classes that have
   a candidate, gets their texts, and returns the confirmed links that join what was apart.
   So every pair that shares a bucket is linked, in one component, or compared, and no
   list of pairs is ever written: a block's rows are at most its classes.

With 24 bands of 4 rows a pair at similarity 0.8 shares no band with probability 3e-6; the
low-bit estimate may lie 0.09 below the threshold, five standard deviations of 512 hashes.

Defined results: a null text counts as empty; texts without words have an empty set and are
linked with nothing; shorter texts are one shingle; repeated rows are linked; rows with a
null key belong to their class but a component is named by its smallest key that is not
null, and `kept` is null for a row without a key; whole texts of any length are read; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm import shingles
from playlog.llm.common import lean, lean_cogroup, slices, staged, text_of
from playlog.llm.components import components

BANDS, ROWS, BITS = 24, 4, 4
HASHES = 512
MARGIN = 0.09
#: Classes of a bucket that are compared at once.
BLOCK = 1024
#: Shingles of a block, about; a block of one class may have more.
SHINGLES = 1 << 22
SALTS = 16
_U = np.uint64


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = shingles.mix(np.arange(1, 2 * n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return x[:n] | _U(1), x[n:]


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(texts, n) minima of n hash functions of 32 bits; sets must not be empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    a, b = _factors(n)
    out = np.empty((len(sets), n), _U)
    for i in range(n):
        out[:, i] = np.minimum.reduceat((flat * a[i] + b[i]) >> _U(32), first)
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(minima), bands), _U)
    for j in range(rows):
        key = key * _U(0xFF51AFD7ED558CCD) + minima[:, j::rows][:, :bands]
    #: the band's number in the lowest byte: keys of two bands never meet
    return ((shingles.mix(key) << _U(8)) | np.arange(bands, dtype=_U)).view(np.int64)


def low_bits(minima: np.ndarray, bits: int) -> np.ndarray:
    """(texts, words) the lowest `bits` of each minimum, packed into 64-bit words."""
    per = 64 // bits
    n, k = minima.shape
    words = -(-k // per)
    low = np.zeros((n, words * per), _U)
    low[:, :k] = minima & _U((1 << bits) - 1)
    low = low.reshape(n, words, per) << (np.arange(per, dtype=_U) * _U(bits))
    return np.bitwise_or.reduce(low, axis=2).view(np.int64)


def _lanes(bits: int) -> int:
    """One bit at the bottom of each lane of `bits`, as a signed long."""
    m = sum(1 << i for i in range(0, 64, bits))
    return m - (1 << 64) if m >> 63 else m


def least_equal(threshold: float, hashes: int, bits: int, margin: float = MARGIN) -> int:
    """Equal lanes that a pair needs: by chance, 2^-bits of the unequal minima agree too."""
    chance = 2.0 ** -bits
    return int(np.ceil(hashes * (chance + (1 - chance) * (threshold - margin))))


def sketches(docs: DataFrame, n: int, lower: bool, bands: int, rows: int, hashes: int,
             bits: int, key: str, text: str) -> DataFrame:
    """Per row: key, h (of the text), n_shingles, set (digest), bands, bits."""
    kind = docs.schema[key].dataType.simpleString()

    def sketch(batches):
        for b in slices(batches, 1024):
            texts = (t.as_buffer().to_pybytes() if t.is_valid else b""
                     for t in b.column(2).cast(pa.binary()))
            size, digest, keys, low = [], [], [], []
            for group in shingles.groups(texts):
                own = shingles.sets(group, n, lower)
                full = [s for s in own if len(s)]
                m = minima(full, hashes) if full else np.zeros((0, hashes), _U)
                k = iter(band_keys(m[:, :bands * rows], bands, rows).tolist())
                w = iter(low_bits(m, bits).tolist())
                for s in own:
                    size.append(len(s))
                    digest.append(np.array([s.sum(dtype=_U), shingles.mix(s + _U(1)).sum(dtype=_U)],
                                           _U).tobytes())
                    keys.append(next(k) if len(s) else [])
                    low.append(next(w) if len(s) else [])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, longs), pa.array(low, longs)],
                ["key", "h", "n_shingles", "set", "bands", "bits"])

    rows_in = docs.select(docs[key].alias("key"), F.xxhash64(text_of(text)).alias("h"),
                          text_of(text).alias("text"))
    return rows_in.mapInArrow(lean(sketch), f"key {kind}, h long, n_shingles long, set binary, "
                                      "bands array<long>, bits array<long>")


def near(pairs: DataFrame, classes: DataFrame, threshold: int, bits: int, hashes: int) -> DataFrame:
    """Of the pairs (a, b), those whose sizes and low bits allow the threshold (per cent)."""
    side = lambda c: classes.select(
        F.col("h").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    x = "(x ^ y)"
    unequal = " | ".join([x, *[f"shiftrightunsigned({x}, {i})" for i in range(1, bits)]])
    padded = -(-hashes // (64 // bits)) * (64 // bits) - hashes
    equal = F.expr(f"aggregate(zip_with(bits_a, bits_b, (x, y) -> {64 // bits} - "
                   f"bit_count(({unequal}) & ({_lanes(bits)}L))), 0, (s, v) -> s + v) - {padded}")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.expr(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
    ).where(equal >= least_equal(threshold / 100, hashes, bits)).select("a", "b")


def texts_of(docs: DataFrame, need: DataFrame, text: str) -> DataFrame:
    """h, text: one row for each text hash in `need`."""
    return docs.select(F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("text")).join(
        need, "h", "left_semi").dropDuplicates(["h"])


def _sets_by_hash(hashes: list[int], texts: pa.ChunkedArray | pa.Array, n: int, lower: bool,
                  own: dict) -> None:
    """Adds the shingle set of each hash that `own` has not yet."""
    raw = {}
    for h, t in zip(hashes, texts.cast(pa.binary()), strict=True):
        if h not in own and h not in raw:
            raw[h] = t.as_buffer().to_pybytes()
    names = iter(raw)
    for group in shingles.groups(raw.values()):
        own |= zip([next(names) for _ in group], shingles.sets(group, n, lower), strict=True)


def _similar(p: np.ndarray, q: np.ndarray, threshold: int) -> bool:
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= threshold * (len(p) + len(q) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, lower: bool, threshold: int) -> DataFrame:
    """The pairs (a, b) of text hashes whose full shingle sets reach the threshold; each pair
    carries its texts."""
    side = lambda c: texts.select(F.col("h").alias(c), F.col("text").alias(f"text_{c}"))

    def check(batches):
        for b in slices(batches, 1024):
            own = {}
            x, y = b.column("a").to_pylist(), b.column("b").to_pylist()
            _sets_by_hash(x, b.column("text_a"), n, lower, own)
            _sets_by_hash(y, b.column("text_b"), n, lower, own)
            keep = [_similar(own[p], own[q], threshold) for p, q in zip(x, y, strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", "text_a", "text_b").mapInArrow(lean(check), "a long, b long")


BLOCK_KEY = ["bucket", "i", "j"]


def dealt(members: DataFrame, block: int) -> DataFrame:
    """Classes of buckets in which several components meet, dealt to blocks.

    `members` has bucket, band, h, label, n_shingles, bits, bands.  Buckets of one component
    need nothing.  Blocks are bounded by classes and by their shingles, so that a block's
    texts fit a worker; each class stands once in every pair of blocks it belongs to."""
    met = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.min("label").alias("low"),
        F.max("label").alias("high")).where("low <> high").select("bucket", F.expr(
            f"cast(least(n, ceil(greatest(n / {block}, size / {SHINGLES}))) AS int)").alias("blocks"))
    return members.join(met, "bucket").withColumn(
        "i", F.expr("cast(pmod(xxhash64(h, 1), blocks) AS int)")
    ).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
        (F.col("i") <= F.col("j")).alias("left"), "h", "label", "n_shingles", "bits",
        F.slice("bands", F.lit(1), F.col("band")).alias("earlier"))


class Candidates:
    """Pairs of a block's classes whose labels differ and whose sizes and low bits allow the
    threshold.  A pair comes from the first band alone whose bucket it shares."""

    def __init__(self, threshold: int, bits: int, hashes: int):
        self.threshold, self.bits = threshold, bits
        self.need = least_equal(threshold / 100, hashes, bits)
        self.lane = np.array([_lanes(bits)], np.int64).view(_U)[0]
        self.padded = -(-hashes // (64 // bits)) * (64 // bits) - hashes

    def __call__(self, t: pa.Table):
        """(place, places it is to be compared with) in the rows of one block."""
        h, label = t["h"].to_numpy(), t["label"].to_numpy()
        size, left = t["n_shingles"].to_numpy(), t["left"].to_numpy(zero_copy_only=False)
        w = np.array(t["bits"].to_pylist(), np.int64).view(_U)
        earlier = np.array(t["earlier"].to_pylist(), np.int64).reshape(len(h), -1)
        same = t["i"][0].as_py() == t["j"][0].as_py()
        y = np.arange(len(h)) if same else np.flatnonzero(~left)
        for x in (np.arange(len(h)) if same else np.flatnonzero(left)).tolist():
            d = w[y] ^ w[x]
            u = d.copy()
            for k in range(1, self.bits):
                u |= d >> _U(k)
            lanes = np.bitwise_count(u & self.lane).sum(axis=1, dtype=np.int64)
            equal = w.shape[1] * (64 // self.bits) - lanes - self.padded
            ok = (equal >= self.need) & (label[y] != label[x]) & (
                100 * np.minimum(size[y], size[x]) >= self.threshold * np.maximum(size[y], size[x]))
            if same:
                ok &= y > x
            ok[ok] = ~(earlier[y[ok]] == earlier[x]).any(axis=1)
            if ok.any():
                yield x, y[ok]


def compared(blocks: DataFrame, candidates: Candidates) -> DataFrame:
    """bucket, i, j, h: the classes of each block that have a candidate there, once each, so
    no block gives more rows than it has classes."""
    def needed(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            ids = np.stack([rest[c].to_numpy() for c in BLOCK_KEY])
            cuts = np.flatnonzero(np.any(ids[:, 1:] != ids[:, :-1], axis=0)) + 1
            at = 0
            for c in cuts.tolist():
                yield emit(rest.slice(at, c - at))
                at = c
            rest = rest.slice(at)
        if rest is not None and len(rest):
            yield emit(rest)

    def emit(t):
        mark = np.zeros(len(t), bool)
        for x, y in candidates(t):
            mark[x] = mark[y] = True
        return pa.RecordBatch.from_arrays(
            [pa.array(t[c].to_numpy()[mark], kind) for c, kind in (
                ("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("h", pa.int64()))],
            [*BLOCK_KEY, "h"])

    return blocks.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).mapInArrow(
        lean(needed), "bucket long, i int, j int, h long")


def linked_in_blocks(blocks: DataFrame, needed: DataFrame, texts: DataFrame, candidates: Candidates,
                     n: int, lower: bool, threshold: int) -> DataFrame:
    """Links among the blocks' candidates that join what was apart, confirmed on full sets.

    A block's classes and the texts it needs meet in one task, which finds the candidates
    again, skips those it has joined already and returns at most one link less than it has
    classes."""
    of = [f"of_{c}" for c in BLOCK_KEY]

    def check(_, found, known):
        own, name, links = {}, {}, []
        if len(found) and len(known):
            _sets_by_hash(known["h"].to_pylist(), known["text"], n, lower, own)
            h, label = found["h"].to_pylist(), found["label"].to_pylist()

            def root(x):
                while name.setdefault(x, x) != x:
                    name[x] = x = name[name[x]]
                return x

            for x, ys in candidates(found):
                for y in ys.tolist():
                    a, b = root(label[x]), root(label[y])
                    if a != b and _similar(own[h[x]], own[h[y]], threshold):
                        name[b] = a
                        links.append((h[x], h[y]))
        return pa.table({c: pa.array([k[i] for k in links], pa.int64())
                         for i, c in enumerate(("a", "b"))})

    some = blocks.join(needed.select(*BLOCK_KEY).distinct(), BLOCK_KEY, "left_semi")
    with_texts = needed.join(texts, "h").withColumnsRenamed(dict(zip(BLOCK_KEY, of)))
    return some.groupBy(*BLOCK_KEY).cogroup(with_texts.groupBy(*of)).applyInArrow(
        lean_cogroup(check), "a long, b long")


def near_dedup(docs: DataFrame, words: int = 5, threshold: int = 80, lower: bool = True,
               key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS,
               hashes: int = HASHES, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Per row of `docs`: key, n_shingles, component_id (smallest key of its component) and
    kept (the row that names its component)."""
    if not (bands * rows <= hashes and bands <= 256):
        raise ValueError("there are at most 256 bands, and they need bands * rows hashes")
    sketch = staged(sketches(docs, words, lower, bands, rows, hashes, bits, key, text),
                    "near-dedup")
    #: a class is named by the smallest text hash among its members
    full = sketch.where("n_shingles > 0")
    named = full.groupBy("set", "n_shingles").agg(F.min("h").alias("class"),
                                                  F.min("key").alias("least"))
    classes = staged(full.groupBy("set", "n_shingles").agg(
        F.min(F.struct("h", "bits", "bands")).alias("c")).select(
        "c.h", "n_shingles", "c.bits", "c.bands"), "near-dedup-classes")
    alone = classes.select("h", F.posexplode("bands").alias("band", "bucket"))
    shared = alone.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(alone.join(shared, "bucket"), "near-dedup-buckets")
    central = members.groupBy("h").agg(F.sum("n").alias("central"))
    hubs = members.join(central, "h").groupBy("bucket").agg(
        F.max(F.struct("central", "h")).alias("hub")).select("bucket", F.col("hub.h").alias("hub"))
    stars = members.join(hubs, "bucket").where("h <> hub").select(
        F.least("h", "hub").alias("a"), F.greatest("h", "hub").alias("b")).distinct()
    first = staged(near(stars, classes, threshold, bits, hashes), "near-dedup-pairs")
    texts = staged(texts_of(docs, members.select("h").distinct(), text), "near-dedup-texts")
    links = staged(confirmed(first, texts, words, lower, threshold), "near-dedup-links")
    labels = components(links)

    of_label = classes.select("h", "n_shingles", "bits", "bands").join(
        labels.withColumnRenamed("v", "h"), "h", "left").withColumn(
        "label", F.coalesce("label", "h"))
    candidates = Candidates(threshold, bits, hashes)
    blocks = staged(dealt(members.drop("n").join(of_label, "h"), block), "near-dedup-blocks")
    needed = staged(compared(blocks, candidates), "near-dedup-needed")
    if not needed.isEmpty():
        more = staged(linked_in_blocks(blocks, needed, texts, candidates, words, lower, threshold),
                      "near-dedup-links")
        if not more.isEmpty():
            labels = components(links.union(more))

    of_class = named.join(labels.select(F.col("v").alias("class"), "label"), "class", "left"
                          ).withColumn("label", F.coalesce("label", "class"))
    component = of_class.groupBy("label").agg(F.min("least").alias("component_id"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = lambda *c: F.expr(f"cast(pmod(xxhash64({', '.join(c)}), {SALTS}) AS int)")
    per_set = of_class.withColumn("salt", salt("class")).join(
        component.withColumn("salt", spread), ["label", "salt"]).select("set", "n_shingles",
                                                                       "component_id")
    out = sketch.select("key", "h", "n_shingles", "set").withColumn("salt", salt("h", "key")).join(
        per_set.withColumn("salt", spread), ["set", "n_shingles", "salt"], "left")
    return out.select(
        F.col("key").alias(key), "n_shingles",
        F.coalesce("component_id", "key").alias("component_id")).withColumn(
        "kept", F.col(key) == F.col("component_id"))
