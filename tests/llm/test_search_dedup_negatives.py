"""Hard negatives, exact stream dedup and ranked search against brute force and on odd rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from playlog.llm import exact_dedup, hard_negatives, ranked_search
from playlog.llm.common import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# ---- ranked search -----------------------------------------------------------------------
def brute_search(docs, items, k):
    """docs: (id, text); items: (id, text)."""
    counts = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scored = []
        for key, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scored.append((-s, key is not None, key or 0, key))
        out += [(item, r, key, -s) for r, (s, _, _, key) in enumerate(sorted(
            scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, **options):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs],
                              "doc_id long, text string, rank int, item string, score int")
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, term int")
    return sorted([tuple(r) for r in ranked_search.search(d.repartition(5), q, k, **options).collect()],
                  key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 30, 200])))
            for _ in range(n)]


@pytest.mark.parametrize("k", [1, 5, 60])
def test_search_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE", 37)
    docs = list(enumerate(texts(1, 300)))
    docs += [(1000 + i, docs[17][1]) for i in range(90)]         # ties
    docs += [(None, docs[5][1]), (7, docs[7][1]), (7, docs[7][1]), (2000, None), (2001, "  ,.\n"),
             (2002, "É\x85ñ W1 w2,W3_w4"), (2003, "w1 " * 5000)]
    items = list(enumerate(texts(2, 25))) + [(100, None), (101, "!?"), (None, "w1 w2"),
                                             (3, "extra w9"), (102, "É\x85ñ unheard")]
    assert found(spark, docs, items, k) == brute_search(docs, items, k)


def test_search_in_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PIECE", 7)
    docs, items = list(enumerate(texts(3, 60))), list(enumerate(texts(4, 12)))
    assert found(spark, docs, items, 9, block_bytes=3000) == brute_search(docs, items, 9)


def test_search_of_nothing(spark):
    assert found(spark, [], [(1, "a")], 5) == []
    assert found(spark, [(1, "a")], [], 5) == []
    assert found(spark, [(1, None), (2, "")], [(1, "a")], 5) == []


def test_no_accumulators_beyond_the_bounds():
    """With the k-th score known, a slice of weak documents makes no accumulator at all, and
    survivors of a late stop are exact."""
    plan = ranked_search.Plan([0], [np.array([0, 1])], [np.array([5000, 10])], 100, 1000, 2)
    batch = pa.RecordBatch.from_pydict({
        "key": list(range(6)), "n": [10] * 6,
        "ids": pa.array([[0, 1], [1], [1], [1], [1], [0]], pa.list_(pa.int32())),
        "tfs": pa.array([[1, 1]] + [[1]] * 5, pa.list_(pa.int64()))})
    part = ranked_search.Slice(batch, plan)
    full = part.scores(plan.terms[0], plan.weights[0], 6, 1)
    limited = part.scores(plan.terms[0], plan.weights[0], 2, 1)
    assert full.min() > 0 and (limited[[0, 5]] == full[[0, 5]]).all() and not limited[1:5].any()
    assert not part.scores(plan.terms[0], plan.weights[0], 2, int(full.max()) * 2).any()


def test_ranked_holds_for_many_partitions(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "id * 7919 % 1000 AS v", "id").repartition(40)
    got = ranked(rows, ["g"], [F.desc("v"), F.asc("id")], 4, salts=3).collect()
    for g in range(3):
        want = sorted([(-(i * 7919 % 1000), i) for i in range(1000) if i % 3 == g])[:4]
        assert sorted((r["rank"], -r["v"], r["id"]) for r in got if r["g"] == g) == [
            (n, *w) for n, w in enumerate(want, 1)]


# ---- exact dedup -------------------------------------------------------------------------
SPACES = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def write(folder, rows, name):
    pq.write_table(pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "text": pa.array([r[1] for r in rows], pa.string()),
        "key": pa.array(["x"] * len(rows)), "digest": pa.array([1] * len(rows)),
        "locator": pa.array([None] * len(rows), pa.int32()),
        "_metadata": pa.array([0] * len(rows))}), f"{folder}/{name}.parquet")


def brute_dedup(files):
    """files: lists of (id, text) in the order of their names."""
    groups = collections.defaultdict(list)
    for f, rows in enumerate(files):
        for i, (key, text) in enumerate(rows):
            text = text or ""
            groups[text.translate(SPACES)].append((-len(text), key is not None, key or 0, f, i, key))
    out = []
    for rows in groups.values():
        rows.sort(key=lambda r: r[:5])
        out += [(r[5], rows[0][5], len(rows), r is rows[0]) for r in rows]
    return sorted(out, key=repr)


def verdicts(df):
    return sorted([tuple(r) for r in df.select("key", "keep_key", "group_size", "kept").collect()],
                  key=repr)


def dedup_files():
    rng = random.Random(9)
    base = [" ".join(rng.choice("abcdé") * rng.randint(1, 4) for _ in range(rng.randint(1, 6)))
            for _ in range(60)]
    files = []
    for f in range(4):
        rows = []
        for i in range(60):
            t = rng.choice(base)
            rows.append((f * 100 + i, rng.choice([t, t.replace(" ", "\n\t"), t.replace(" ", ""), t + "  "])))
        files.append(rows)
    files[0] += [(None, None), (1, ""), (1, "   "), (None, "ab"), (500, "a b"), (501, "a\x85b"),
                 (502, "a b"), (503, "x" * 200_000), (504, "x " * 200_000), (505, "x" * 200_000)]
    files[3] += [(None, None), (7, "dup"), (7, "dup")]
    return files


def weak(text):
    return F.encode((F.crc32(text.cast("binary")) % 5).cast("string"), "UTF-8")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_dedup_equals_brute_force(spark, tmp_path, digest):
    """Also where few digests stand for all texts: the whole texts decide."""
    files = dedup_files()
    for i, rows in enumerate(files):
        write(tmp_path, rows, f"part-{i}")
    got = exact_dedup.exact_dedup(spark, str(tmp_path), digest=digest, files_per_batch=1)
    assert verdicts(got) == brute_dedup(files)
    if digest is exact_dedup.sha256:
        want = {hashlib.sha256((t or "").translate(SPACES).encode()).hexdigest()
                for rows in files for _, t in rows}
        assert {bytes(r["digest"]).hex() for r in got.collect()} == want


def test_exact_dedup_goes_on_with_new_files(spark, tmp_path):
    files, root = dedup_files(), f"{tmp_path}/root"
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(files):
        write(tmp_path / "in", rows, f"part-{i}")
        got = exact_dedup.exact_dedup(spark, f"{tmp_path}/in", root=root)
        assert verdicts(got) == brute_dedup(files[:i + 1])
    # the narrow rows of a file were written once
    assert spark.read.parquet(f"{root}/rows").count() == sum(map(len, files))


def test_exact_dedup_of_an_empty_table(spark, tmp_path):
    write(tmp_path, [], "part-0")
    assert exact_dedup.exact_dedup(spark, str(tmp_path)).collect() == []


def test_exact_dedup_runs_no_python(spark, tmp_path):
    write(tmp_path, [(1, "a"), (2, "a ")], "part-0")
    plan = exact_dedup.exact_dedup(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- hard negatives ----------------------------------------------------------------------
def brute_negatives(rows, positives=5, negatives=3):
    """rows: (id, label, vector); anchors are ids divisible by 5."""
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, v in ok:
        if a is None or a % 5:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i is not None, i or 0, i, other)
                        for i, other, w in ok if i is None or i != a)
        for s, _, _, p, _ in [x for x in scored if x[4] == lab][:positives]:
            near = [x for x in scored if x[4] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a, p, r, x[3], -s, -x[0]) for r, x in enumerate(near[:negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, lab, v, 1, 2, True) for i, lab, v in rows],
                               "vec_id long, label int, embedding array<float>, key int, block int, "
                               "anchor boolean").repartition(6)
    got = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **options)
    return sorted([tuple(r) for r in got.collect()], key=repr)


def vectors(seed, n, width, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(3)), [float(x) for x in np.float32(rng.normal(size=width) * scale)])
            for i in range(n)]


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 23)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rows = vectors(1, 160, 6)
    rows += [(200 + i, 1, rows[3][2]) for i in range(40)]          # equal vectors: ties
    rows += [(300 + i, 2, rows[3][2]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [(400, None, rows[0][2]), (405, 1, None), (410, 1, [nan] * 6), (415, 1, [inf] + [0.0] * 5),
             (420, 1, [None, 0.5] + [0.0] * 4), (None, 1, rows[3][2]), (None, 2, rows[5][2]),
             (425, 1, [0.0] * 6), (430, 2, [1.0, 0.5]), (435, 9, rows[3][2])]
    assert mined(spark, rows) == brute_negatives(rows)


def test_blocks_of_anchors_and_repeated_rows(spark):
    rows = vectors(2, 120, 5)
    assert mined(spark, rows, block=4) == brute_negatives(rows)
    rows += [rows[10], rows[10], rows[12]]
    assert mined(spark, rows) == brute_negatives(rows)


@pytest.mark.parametrize("width, scale", [(1, 1.0), (64, 0.1), (150, 50.0), (130, 3000.0)])
def test_residue_products_are_exact(spark, width, scale):
    """Long vectors and large components take several chunks and more primes."""
    rng = np.random.default_rng(3)
    a = np.floor(256 * rng.normal(size=(20, width)) * scale).astype(np.int64)
    b = np.floor(256 * rng.normal(size=(30, width)) * scale).astype(np.int64)
    a[0], b[0] = a[0].max(), -a.max()
    most = int(max(abs(a).max(), abs(b).max()))
    primes = hard_negatives.primes_for(width * most ** 2)
    got = hard_negatives.products(hard_negatives.residues(a, primes),
                                  hard_negatives.residues(b, primes), primes)
    assert (got == a @ b.T).all()


def test_wide_vectors(spark):
    rows = vectors(4, 60, 150, 40.0)
    assert mined(spark, rows) == brute_negatives(rows)


def test_no_rows_no_anchors_too_large(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 1, [0.5])]) == []
    assert mined(spark, [(5, 1, []), (6, 1, []), (7, 2, [])]) == brute_negatives(
        [(5, 1, []), (6, 1, []), (7, 2, [])])
    with pytest.raises(ValueError, match="greatest allowed"):
        mined(spark, [(5, 1, [1e30]), (6, 1, [1.0])])
