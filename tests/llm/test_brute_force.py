"""The classifier's fit and the fingerprints against versions in plain Python."""

import collections
import math
import random

import numpy as np

from playlog.llm import fingerprints, shingles, toxicity

M64 = (1 << 64) - 1


# ---- toxicity ----------------------------------------------------------------------------
def features(text):
    """Hashed n-grams by whole numbers, one after the other."""
    codes = [ord(c) + 1 for c in text.lower()]
    found = set()
    for n in toxicity.ORDERS:
        for i in range(len(codes) - n + 1):
            h = 0
            for c in codes[i:i + n]:
                h = (h * 0xD6E8FEB86659FD93 + c) & M64
            found.add(((h * 0x9E3779B97F4A7C15) & M64) >> (64 - toxicity.SPACE_BITS))
    return found


def sample(seed, n):
    rng = random.Random(seed)
    calm, foul = ["field", "river", "stone", "cloud", "é un"], ["blarg", "skronk", "field"]
    texts, toxic = [], []
    for _ in range(n):
        bad = rng.random() < 0.4
        texts.append(" ".join(rng.choice(foul if bad and rng.random() < 0.5 else calm)
                              for _ in range(rng.randint(1, 12))))
        toxic.append(float(bad))
    return texts, np.array(toxic)


def test_features_one_by_one(monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 7)
    for text in ["", "ab", "abc", "Grüße, 😀 an ALLE", "x" * 40, "a b\nc\x00d" * 9]:
        assert set(toxicity.distinct(text).tolist()) == features(text)


def test_fit_is_the_scaled_logistic_regression():
    texts, toxic = sample(1, 150)
    model = toxicity.fit(texts, toxic)
    own = [features(t) for t in texts]
    bad = collections.Counter(f for s, t in zip(own, toxic) if t for f in s)
    good = collections.Counter(f for s, t in zip(own, toxic) if not t for f in s)
    n_bad, n_good, s = toxic.sum(), len(toxic) - toxic.sum(), toxicity.SMOOTHING
    ratio = {f: math.log((bad[f] + s) / (n_bad + 2 * s)) - math.log((good[f] + s) / (n_good + 2 * s))
             for f in bad | good}
    kept = {f for f in ratio if bad[f] + good[f] >= toxicity.LEAST_ROWS and ratio[f]}
    assert len(kept) < toxicity.FEATURES and set(np.flatnonzero(model.weights)) <= kept
    w = {f: model.weights[f] / ratio[f] for f in kept}

    def loss(w, b):
        total = 0.0
        for feats, t in zip(own, toxic):
            z = b + sum(w[f] * ratio[f] for f in feats & kept)
            total += math.log1p(math.exp(-z if t else z))
        return total / len(own) + toxicity.PENALTY / 2 * sum(x * x for x in w.values())

    # plain gradient descent, far longer than the fit's rounds, finds nothing better
    v, b = dict.fromkeys(kept, 0.0), 0.0
    for _ in range(400):
        g, gb = dict.fromkeys(kept, 0.0), 0.0
        for feats, t in zip(own, toxic):
            z = b + sum(v[f] * ratio[f] for f in feats & kept)
            e = (1 / (1 + math.exp(-z)) - t) / len(own)
            gb += e
            for f in feats & kept:
                g[f] += e * ratio[f]
        v = {f: x - 0.05 * (g[f] + toxicity.PENALTY * x) for f, x in v.items()}
        b -= 0.05 * gb
    assert loss(w, model.intercept) <= loss(v, b) + 1e-3

    marked = model.weights != 0
    for text, feats in zip(texts, own):
        z = model.intercept + sum(model.weights[f] for f in feats)
        assert abs(toxicity.score(model, marked, text) - 1 / (1 + math.exp(-z))) < 1e-9


# ---- fingerprints ------------------------------------------------------------------------
def mix(x):
    x ^= x >> 30
    x = (x * 0xBF58476D1CE4E5B9) & M64
    x ^= x >> 27
    x = (x * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def packed(hashes):
    """One permutation, bin by bin, filled up from donors and packed, in whole numbers."""
    if not hashes:
        return b""
    n, bits = fingerprints.BINS, fingerprints.BITS
    first = {}
    for h in hashes:
        i, value = h >> (64 - (n.bit_length() - 1)), mix(h) >> 1
        first[i] = min(first.get(i, M64), value)
    out = bytearray(n * bits // 8)
    for i in range(n):
        donor, attempt = i, 0
        while donor not in first:
            attempt += 1
            donor = mix((i * 0x9E3779B97F4A7C15 + attempt) & M64) % n
        low = mix(first[donor] ^ ((i * 0x9E3779B97F4A7C15) & M64)) & ((1 << bits) - 1)
        out[i * bits // 8] |= low << (i * bits % 8)
    return bytes(out)


def like(a, b):
    if not a or not b:
        return float(a == b)
    n, bits = fingerprints.BINS, fingerprints.BITS

    def lane(x, i):
        return (x[i * bits // 8] >> (i * bits % 8)) & ((1 << bits) - 1)

    equal = sum(lane(a, i) == lane(b, i) for i in range(n)) / n
    return min(1.0, max(0.0, (equal - 2.0 ** -bits) / (1 - 2.0 ** -bits)))


def texts_of(seed, n):
    rng = random.Random(seed)
    return ["", " \n", "one", "one two three four five"] + [
        " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 6, 30, 300]))) for _ in range(n)]


def test_fingerprints_bin_by_bin():
    raw = [t.encode() for t in texts_of(1, 40)]
    for text, print_, hashes in zip(raw, fingerprints.fingerprints(raw), shingles.shingles(raw, 5)):
        assert print_ == packed([int(h) for h in hashes]), text
    some = fingerprints.fingerprints(raw)
    for a, b in zip(some, some[1:] + some[:1]):
        assert abs(fingerprints.likeness(a, b) - like(a, b)) < 1e-12


def test_the_chain_of_edited_texts(spark):
    texts = texts_of(2, 30)
    rows = [(3 * i % 101, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in fingerprints.chained(df).collect()}
    order = sorted(rows, reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 3
        changed = "".join([*text[:len(text) - cut], *after[:cut]])
        one, two, three = (packed([int(h) for h in s]) for s in shingles.shingles(
            [text.encode(), changed.encode(), after.encode()], 5))
        r = got[i]
        assert (r["n_chars"], r["edited"], bytes(r["fingerprint"]), bytes(r["edited_fingerprint"])) == (
            len(text), changed, one, two)
        assert abs(r["near_edited"] - like(one, two)) < 1e-12
        assert abs(r["near_next"] - like(one, three)) < 1e-12
