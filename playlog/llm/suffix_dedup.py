"""Suffix-array deduplication with a logarithmic index family.

A byte goes if it is covered by a string of `length` bytes that also starts earlier, in a
document of smaller key or earlier in the same one.  Strings never cross documents.

1. Every string of `length` bytes has an anchor: the 32 bytes in it whose hash is smallest
   (leftmost if several are).  Equal strings have equal anchors at equal places, and
   neighbouring strings share theirs, so a text has about one anchor per 35 bytes.
2. Anchors are dealt to shards by hash, as packed arrays.  Strings whose anchor occurs once
   in the corpus cannot repeat; only repeated anchors go on.
3. The surroundings of repeated anchors go to shards by the anchor's hash.  A shard takes
   its suffixes in document order, in batches.  A batch gets a suffix array: its suffixes
   sorted by the fingerprint of their first `length` bytes, which is the order that
   matters, as only matches of that length count.  It is merge-scanned against the
   sorted levels of the index family; what is found there, or earlier in the batch, repeats.
   New suffixes become a level, and levels of equal size merge, so there are about
   log2(batches) of them.
4. The repeated starts return to their documents as runs, whose union is removed.

Work arrays are bounded by `PIECE` bytes of text or `BATCH` suffixes; a shard holds a hash
share of the anchors.  Neighbouring anchors of equal hash, as in repetitive text, are one run
with one surrounding.  Fingerprints are 64 bits and compared within a shard only: a match is not
confirmed on bytes.  The levels serve one call; a later call starts anew.

Defined results: a null text counts as empty; texts shorter than `length` lose nothing; whole
texts of any length are read; rows of equal key (and `tie`) are one document's versions, so
neither copy starts earlier and equal rows keep or lose the same; a null key is smaller than
any other, or larger if asked; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import lean, lean_cogroup, lean_group, shards, slices, text_of
from playlog.llm.shingles import mix

GRAM = 32
PIECE = 1 << 20
BATCH = 1 << 19
#: Starts of a run of surroundings.
SEGMENT = 1 << 17
#: Shards to a shuffle partition: a worker holds one shard at a time.
SHARDS = 2
_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def rolling(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each place, by doubling."""
    if len(data) < n:
        return np.zeros(0, _U)
    base, out, out_n, at = mix(data.astype(_U) + _U(1)), None, 0, 1
    while True:
        if n & at:
            if out is None:
                out, out_n = base, at
            else:
                m = len(base) - out_n
                out = base[out_n:] + out[:m] * _U(pow(_MULTIPLIER, at, 1 << 64))
                out_n += at
        if at * 2 > n:
            return mix(out[:len(data) - n + 1])
        base = base[at:] + base[:-at] * _U(pow(_MULTIPLIER, at, 1 << 64))
        at *= 2


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of `width` values from each place on, leftmost if tied."""
    best = (values & _U(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=_U)
    have = 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return (best & _U(0xFFFFFFFF)).astype(np.int64)


def anchors(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor of one text: place, hash, and the first and last start of its strings."""
    places, hashes, firsts, lasts = [], [], [], []
    for at in range(0, max(0, len(text) - length + 1), PIECE):
        part = text[at:at + PIECE + length - 1]
        h = rolling(part, GRAM)
        best = leftmost_minima(h, length - GRAM + 1)
        cut = np.flatnonzero(np.diff(best, prepend=-1))
        places.append(best[cut] + at)
        hashes.append(h[best[cut]])
        firsts.append(cut + at)
        lasts.append(np.append(cut[1:], len(best)) - 1 + at)
    if not places:
        none = np.zeros(0, np.int64)
        return none, none.astype(_U), none, none
    return tuple(map(np.concatenate, (places, hashes, firsts, lasts)))


def runs_of(h: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Anchors with neighbours of the same hash joined into runs of at most SEGMENT starts.  In
    repetitive text every byte is an anchor, and each would bring its own surroundings."""
    if not len(h):
        return h, first, last
    apart = (h[1:] != h[:-1]) | (first[1:] != last[:-1] + 1)
    begin = np.flatnonzero(np.append(True, apart))
    end = np.append(begin[1:], len(h)) - 1
    h, first, last = h[begin], first[begin], last[end]
    pieces = (last - first) // SEGMENT + 1
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    h, first, last = (np.repeat(x, pieces) for x in (h, first, last))
    return h, first + nth * SEGMENT, np.minimum(first + (nth + 1) * SEGMENT - 1, last)


def twice_at_most(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hashes, of a run of equal neighbouring anchors only two: it repeats anyway."""
    same = np.append(False, (h[1:] == h[:-1]) & (first[1:] == last[:-1] + 1)) if len(h) else h > 0
    third = same & np.append(False, same[:-1]) if len(h) else same
    return h[~third]


class Family:
    """Sorted levels of distinct fingerprints; levels of equal size class merge."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Merge-scan of sorted keys against every level."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.levels.append(keys)
        while len(self.levels) > 1 and (self.levels[-1].size.bit_length()
                                        >= self.levels[-2].size.bit_length()):
            last = self.levels.pop()
            merged = np.concatenate([self.levels.pop(), last])
            merged.sort(kind="stable")  # two sorted runs: a merge
            self.levels.append(merged)


def _pack(**arrays: np.ndarray) -> dict[str, bytes]:
    return {k: v.tobytes() for k, v in arrays.items()}


def _bytes(column: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() for x in column.cast(pa.binary())]


def _deal(shard: np.ndarray, n: int):
    """Each shard present, with its members' places."""
    order = np.argsort(shard, kind="stable")
    edge = np.searchsorted(shard[order], np.arange(n + 1))
    for s in range(n):
        if edge[s] < edge[s + 1]:
            yield s, order[edge[s]:edge[s + 1]]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


_ANCHORS = "shard int, hash binary, doc binary"
_REPEATED = "shard int, doc binary, hash binary"
_AROUND = ("shard int, key binary, tie binary, doc binary, start binary, count binary, size binary, "
           "text binary")
_RUNS = "shard int, doc binary, start binary, count binary"


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100,
                 carry: tuple[str, ...] = (), tie: Column | None = None,
                 nulls_last: bool = False) -> DataFrame:
    """`docs`' key and text (as bytes), with `runs`: binary pairs (start, end) of signed 64-bit
    integers, the maximal removed runs of the text's UTF-8 bytes; and, if columns to `carry`
    are named, `rest`, a struct of theirs.

    Documents are ordered by the key, null first or last, then by `tie`, a long that equal
    rows must share; rows equal in both are one document's versions."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} at least")
    n = SHARDS * shards(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("documents are ordered by an integer key")
    rest = [F.struct(*(docs[c] for c in carry)).alias("rest")] if carry else []
    #: h names a row's key and text; rows in which both are equal share one fate
    rows = docs.select(
        docs[key].alias("key"), F.encode(text_of(text), "UTF-8").alias("text"),
        F.coalesce(F.lit(0) if tie is None else tie, F.lit(0)).cast("long").alias("tie"), *rest
    ).withColumn("h", F.xxhash64("key", "text")).withColumn(
        "shard", F.expr(f"cast(pmod(h, {n}) AS int)"))

    def find(batches):
        schema = _schema(_ANCHORS)
        for b in batches:
            hs, owners, total = [], [], 0
            names = b.column(0).to_numpy()
            for i, t in enumerate(b.column(1)):
                _, h, first, last = anchors(np.frombuffer(t.as_buffer(), np.uint8), length)
                h = twice_at_most(h, first, last)
                hs.append(h)
                owners.append(np.full(len(h), names[i], np.int64))
                total += len(h)
                if total > BATCH or i == len(b) - 1:
                    h, o = np.concatenate(hs), np.concatenate(owners)
                    yield _rows([(s, h[m].tobytes(), o[m].tobytes())
                                 for s, m in _deal((h >> _U(8)) % _U(n), n)], schema)
                    hs, owners, total = [], [], 0

    def repeated(_, t):
        h = np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in t["hash"]])
        doc = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in t["doc"]])
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        same = h[1:] == h[:-1]
        keep = np.append(same, False) | np.append(False, same)
        h, doc = h[keep], doc[keep]
        return pa.Table.from_batches([_rows(
            [(s, doc[m].tobytes(), h[m].tobytes()) for s, m in _deal(np.mod(doc, n), n)],
            _schema(_REPEATED))])

    def around(_, docs, marks):
        """The surroundings of each repeated anchor, by the anchor's shard."""
        schema = _schema(_AROUND)
        if not len(docs) or not len(marks):
            return schema.empty_table()
        doc = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in marks["doc"]])
        hashes = np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in marks["hash"]])
        order = np.argsort(doc, kind="stable")
        doc, hashes = doc[order], hashes[order]
        out, waiting, total, seen = [], [], 0, set()

        def flush():
            part = [np.concatenate([w[i] for w in waiting]) for i in range(7)]
            begin = np.cumsum(part[6]) - part[6]
            data = np.frombuffer(b"".join(w[7] for w in waiting), np.uint8)
            for s, m in _deal((part[0] >> _U(8)) % _U(n), n):
                body = b"".join([data[a:a + k].tobytes() for a, k in zip(
                    begin[m].tolist(), part[6][m].tolist(), strict=True)])
                packed = _pack(key=part[1][m], tie=part[2][m], doc=part[3][m], start=part[4][m],
                               count=part[5][m].astype("<i4"), size=part[6][m].astype("<i4"))
                out.append((s, packed["key"], packed["tie"], packed["doc"], packed["start"], packed["count"],
                            packed["size"], pa.compress(body, codec="zstd", asbytes=True)))
            waiting.clear()

        limits = np.iinfo(np.int64)
        none = limits.max if nulls_last else limits.min
        for name, k, order, t in zip(docs["h"].to_numpy(), docs["key"].to_pylist(),
                                     docs["tie"].to_numpy(), docs["text"], strict=True):
            if name in seen:
                continue
            seen.add(name)
            a, b = np.searchsorted(doc, name), np.searchsorted(doc, name, side="right")
            if a == b:
                continue
            data = np.frombuffer(t.as_buffer(), np.uint8)
            _, h, first, last = anchors(data, length)
            hit = np.isin(h, hashes[a:b])
            h, first, last = runs_of(h[hit], first[hit], last[hit])
            count = last - first + 1
            size = count + length - 1
            raw = data.tobytes()
            body = b"".join([raw[x:x + z] for x, z in zip(
                first.tolist(), size.tolist(), strict=True)])
            waiting.append((h, np.full(len(h), none if k is None else k, np.int64),
                            np.full(len(h), order, np.int64), np.full(len(h), name, np.int64),
                            first, count, size, body))
            total += len(body)
            if total > 8 * PIECE:
                flush()
                total = 0
        if waiting:
            flush()
        return pa.Table.from_batches([_rows(out, schema)])

    def scan(_, t):
        """One shard's suffixes in document order against the index family."""
        col = lambda c, kind: np.concatenate(
            [np.frombuffer(x.as_buffer(), kind) for x in t[c]])
        key, tie, doc, start = (col(c, np.int64) for c in ("key", "tie", "doc", "start"))
        count, size = col("count", "<i4").astype(np.int64), col("size", "<i4").astype(np.int64)
        sizes = [int(np.frombuffer(x.as_buffer(), "<i4").sum()) for x in t["size"]]
        data = np.frombuffer(b"".join(
            pa.decompress(x.as_py(), decompressed_size=s, codec="zstd", asbytes=True)
            for x, s in zip(t["text"], sizes, strict=True)), np.uint8)
        begin = np.cumsum(size) - size
        order = np.lexsort((start, tie, key))
        ends = np.cumsum(count[order])
        #: a document's number, and whether it has several versions here
        document = np.cumsum(np.append(True, (np.diff(key[order]) != 0) | (np.diff(tie[order]) != 0)))
        head_of = np.searchsorted(document, document)
        versions = np.bincount(document, doc[order] != doc[order][head_of])[document] > 0
        family, runs, at = Family(), [], 0
        while at < len(order):
            #: versions of one document meet in a batch; others end anywhere
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + BATCH)))
            while to < len(order) and versions[to] and document[to] == document[to - 1]:
                to += 1
            own, number = order[at:to], document[at:to]
            body = np.concatenate([data[a:a + k] for a, k in zip(
                begin[own].tolist(), size[own].tolist(), strict=True)])
            prints = rolling(body, length)
            c, z = count[own], size[own]
            base = np.cumsum(z) - z
            owner = np.repeat(np.arange(len(own)), c)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(c) - c, c)
            prints = prints[base[owner] + within]
            suffixes = np.argsort(prints, kind="stable")  # ties stay in document order
            s = prints[suffixes]
            fresh = np.append(True, s[1:] != s[:-1])
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(s)), 0))
            who, where = owner[suffixes], start[own][owner[suffixes]] + within[suffixes]
            k = number[who]
            #: the earliest holder itself, and versions of its document that start there
            earliest = (k == k[head]) & (where == where[head])
            known = family.holds(s[fresh])
            known = known[np.cumsum(fresh) - 1]
            again = np.zeros(len(s), bool)
            again[suffixes] = known | ~earliest
            family.add(s[fresh & ~known])
            hit = np.flatnonzero(again)
            if len(hit):
                new = np.append(True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]]))
                first = hit[new]
                length_of = np.diff(np.append(np.flatnonzero(new), len(hit)))
                o = owner[first]
                runs.append((doc[own][o], start[own][o] + within[first], length_of))
            at = to
        if not runs:
            return _schema(_RUNS).empty_table()
        doc, start, count = map(np.concatenate, zip(*runs, strict=True))
        return pa.Table.from_batches([_rows(
            [(s, doc[m].tobytes(), start[m].tobytes(), count[m].tobytes())
             for s, m in _deal(np.mod(doc, n), n)], _schema(_RUNS))])

    def remove(_, docs, marks):
        """Each row of the shard with the union of its repeated strings."""
        by = {}
        if len(marks):
            doc, start, count = (np.concatenate(
                [np.frombuffer(x.as_buffer(), np.int64) for x in marks[c]])
                for c in ("doc", "start", "count"))
            order = np.lexsort((start, doc))
            doc, start, end = doc[order], start[order], (start + count + length - 1)[order]
            cut = np.flatnonzero(np.diff(doc, prepend=doc[0] - 1))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)], strict=True):
                s, reach = start[a:b], np.maximum.accumulate(end[a:b])
                new = np.append(True, s[1:] > reach[:-1])
                last = np.append(np.flatnonzero(new)[1:], len(s)) - 1
                by[int(doc[a])] = np.stack([s[new], reach[last]], axis=1).astype("<i8").tobytes()
        return pa.table({
            "key": docs["key"], "text": docs["text"],
            "runs": pa.array([by.get(h, b"") for h in docs["h"].to_pylist()], pa.binary()),
            **({"rest": docs["rest"]} if carry else {})})

    found = rows.select("h", "text").mapInArrow(lean(find), _ANCHORS)
    marks = found.groupBy("shard").applyInArrow(lean_group(repeated), _REPEATED)
    carried = f", rest {rows.schema['rest'].dataType.simpleString()}" if carry else ""
    dealt = rows.select("key", "text", "tie", "h", "shard", *["rest"] * bool(carry)).groupBy("shard")
    near = dealt.cogroup(marks.groupBy("shard")).applyInArrow(lean_cogroup(around), _AROUND)
    runs = near.groupBy("shard").applyInArrow(lean_group(scan), _RUNS)
    return dealt.cogroup(runs.groupBy("shard")).applyInArrow(
        lean_cogroup(remove), f"key {kind}, text binary, runs binary{carried}").withColumnRenamed("key", key)


def without_runs(dedup: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, `kept` (the remaining bytes) and `text`: the
    remaining text, in which a character goes only if all its bytes do; and `rest`, if `dedup`
    has it."""
    kind = dedup.schema[key].dataType.simpleString()
    rest = [c for c in dedup.columns if c == "rest"]
    carried = "".join(f", {c} {dedup.schema[c].dataType.simpleString()}" for c in rest)

    def cut(batches):
        for b in slices(batches):
            size, gone, spans, kept, texts = [], [], [], [], []
            for t, r in zip(b.column(1), b.column(2), strict=True):
                raw = t.as_buffer().to_pybytes()
                runs = np.frombuffer(r.as_buffer(), "<i8").reshape(-1, 2).tolist()
                size.append(len(raw))
                gone.append(sum(e - s for s, e in runs))
                spans.append(len(runs))
                kept.append(_cut(raw, runs))
                texts.append(_cut(raw, [whole_characters(raw, s, e) for s, e in runs]).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(texts, pa.string()), *b.columns[3:]],
                ["key", "n_bytes", "n_removed", "n_spans", "kept", "text", *rest])

    return dedup.select(F.col(key).alias("key"), "text", "runs", *rest).mapInArrow(
        lean(cut), f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
             f"text string{carried}"
    ).withColumnRenamed("key", key)


def _cut(raw: bytes, runs: list) -> bytes:
    out, at = [], 0
    for s, e in runs:
        out.append(raw[at:s])
        at = max(at, e)
    return b"".join([*out, raw[at:]])


def whole_characters(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """The part of [start, end) made of whole UTF-8 characters."""
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end
