"""Periodic runs, whitening and SimHash components against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from parcel_engine.llm import anchors, periods, whitening
from parcel_engine.llm.common import U64, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, fp string, n_runs string, start int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- periodic runs ---------------------------------------------------------------------


def runs_of(w, least=12):
    """(start, length, period) by following each period through the words."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q - s), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@given(st.lists(st.lists(st.integers(1, 3), max_size=70), min_size=1, max_size=3), st.sampled_from([2, 5, 12]))
@settings(deadline=None, max_examples=200)
def test_runs_are_those_of_all_periods(texts, least):
    at = np.cumsum([0, *map(len, texts)])
    w = mix(np.array(sum(texts, []), np.int64).astype(U64))
    got = list(zip(*(v.tolist() for v in periods.find_runs(w, at, least))))
    assert got == [(k, *r) for k, t in enumerate(texts) for r in runs_of(t, least)]


def test_long_runs_cost_little():
    for w in (np.ones(60_000), np.arange(60_000) % 17_000, np.r_[np.arange(30_000), np.arange(30_000)]):
        row, start, length, period = periods.find_runs(mix(w.astype(U64)), np.array([0, len(w)]))
        assert (start.tolist(), length.tolist()) == ([0], [60_000]) and period[0] in (1, 17_000, 30_000)


def altered(doc, w):
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def periodic_row(doc, text, alter):
    w = WORD.findall(text or "")
    w = altered(doc, w) if alter else w
    runs = runs_of(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("alter", [True, False])
def test_periodic_rows(spark, alter):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a " * 40, "a b\tc\n" * 9 + "x", "é à\r\n" * 30, "A a " * 12, "one two three", " ".join(f"w{i % 900}" for i in range(4000))]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 120))) for _ in range(150)]
    texts += [" ".join(f"{i}w{k}" for k in range(60)) + " " + "x y z " * (i % 7) for i in range(150)]
    rows = [*enumerate(texts), (None, "q r " * 20), (3, "a " * 40)]
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in rows], DOCS).repartition(3)
    out = periods.periodic_runs(docs, alter=alter)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted((periodic_row(i, t, alter) for i, t in rows), key=key)


def test_digests_of_long_texts_are_joined_in_blocks(monkeypatch):
    monkeypatch.setattr(periods, "BLOCK", 7)
    import pyarrow as pa

    texts = ["a bb  ccc", "", "\n", " ".join(map(str, range(40))), "é"]
    (chunk,) = periods.words(pa.array(texts), lower=False)
    got = periods.joined_digests(chunk, np.arange(len(chunk.start)), chunk.at)
    assert got == [hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() for t in texts]


# --- whitening -------------------------------------------------------------------------


def check_whitening(rows, out, wanted=32):
    good = [(i, v) for i, v in rows if v and None not in v and np.isfinite(v).all() and max(v) < 1e16]
    good = [(i, v) for i, v in good if len(v) == max(len(v) for _, v in good)]
    x = np.array([np.floor(64 * np.array(v, float)).astype(int) + 1_000_000 for _, v in good])
    n, total = len(x), x.sum(0)
    c = x - total / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(wanted, int((values > 1e-9 * values[0]).sum()))
    assert len(out) == n * k
    by = {}
    for r in out:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    deviation = sorted((str(i), int(d)) for (i, _), d in zip(good, ((n * x - total) ** 2).sum(1)))
    for j in range(k):
        got = sorted(by[j + 1], key=lambda r: (str(r.vec_id), r.whitened))
        assert sorted((str(r.vec_id), r.deviation) for r in got) == deviation
        assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-8
        assert np.isclose(got[0].explained, values[j] / values.sum(), rtol=1e-9)
        if len(values) > 1 and min(abs(np.delete(values, j) - values[j])) > 1e-3 * values[0]:
            want = (c @ vectors[:, j]) / np.sqrt(values[j])
            a, b = (np.array([w for _, w in sorted(zip((str(i) for i, _ in good), s * want))]) for s in (1, -1))
            w = np.array([r.whitened for r in got])
            assert min(abs(w - a).max(), abs(w - b).max()) < 1e-7


def test_whitening_is_that_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((300, 12)) @ np.diag(1.5 ** -np.arange(12)) + rng.standard_normal(12)
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, [1.0]), (905, []), (906, [1e300] * 12)]
    rows += [(None, rows[3][1]), (1000, rows[3][1])]
    docs = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], "vec_id long, embedding array<double>, n int, x string").repartition(3)
    out = whitening.whitened_vectors(docs)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(rows, out.collect())
    check_whitening(rows, whitening.whitened_vectors(docs, components=3).collect(), 3)


def test_whitening_of_few_or_like_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    frame = lambda rows: whitening.whitened_vectors(spark.createDataFrame(rows, schema))
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert frame(rows).count() == 0
    # fewer vectors than dimensions, and dimensions that say the same
    rows = [(i, [float(i % 3), float(i % 3), float(i == 1), 5.0, 0.0]) for i in range(5)]
    check_whitening(rows, frame(rows).collect())


def test_bidiagonalisation_finds_copies_of_a_value():
    rng = np.random.default_rng(2)
    basis = np.linalg.qr(rng.standard_normal((40, 10)))[0]
    turn = np.linalg.qr(rng.standard_normal((10, 10)))[0]
    values = np.array([5, 5, 5, 3, 3, 1, 1, 1, 0, 0.0])
    x = basis * values @ turn.T
    product = lambda y: (x.T @ (x @ y), float(((x @ y) ** 2).sum()))
    found, vectors = whitening.Bidiagonalisation(product, 10, np.sqrt((values**2).sum())).run(6)
    assert np.allclose(found, values[:6], atol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12)
    assert np.allclose(x.T @ (x @ vectors), vectors * found**2, atol=1e-10)


def test_deviations_are_exact_or_null():
    x = np.array([[900, -5_000], [3, 8]])
    for n in (11, 500_000, 3_000_001):
        want = [sum((n * (a - b) - r) ** 2 for a, b, r in zip(v, (2, 7), (5, 1))) for v in x.tolist()]
        got = whitening.Centre(n, np.array([2, 7]), np.array([5, 1])).deviations(x).to_pylist()
        assert got == [w if w < 1 << 63 else None for w in want]
    assert None in got


# --- SimHash ---------------------------------------------------------------------------


def fingerprint(text):
    w = WORD.findall(lower(text))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_fingerprints_meet_at_the_home_of_one():
    rng = random.Random(4)
    for _ in range(2000):
        x = rng.choice([0, rng.getrandbits(64), (1 << 64) - 1])
        y = x
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << b
        at, anchor, home = anchors.anchors(np.array([x, y], U64))
        homes = set(anchor[(at == 0) & home].tolist())
        assert len(homes) == 2 and homes & set(anchor[at == 1].tolist())


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=40))
@settings(deadline=None)
def test_forests_connect_the_same(links):
    def parts(chosen):
        part = list(range(13))
        for a, b in chosen:
            part = [part[a] if p == part[b] else p for p in part]
        return {tuple(i for i in range(13) if part[i] == p) for p in part}

    a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    kept = [x for x, k in zip(links, anchors.forest(a, b)) if k]
    assert parts(kept) == parts(links) and len(kept) == 13 - len(parts(links))


@pytest.mark.parametrize("block", [3, anchors.BLOCK])
def test_simhash_components_are_exact(spark, block):
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one\ttwo"), (None, "one two three four"), (7, "one two three four"), (7, "five six seven"), (3, "one")]
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(rng.randint(3, 200))]
        for _ in range(40):
            rows.append((10_000 - len(rows), " ".join(w if rng.random() > 0.006 else f"r{rng.random()}" for w in base)))
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in rows], DOCS).repartition(4)
    prints = [(i, fingerprint(t)) for i, t in rows]
    real = {f: min(i for i, x in prints if x == f and i is not None) for i, f in prints if i is not None}
    part = {f: f for f in real}

    def root(f):
        while part[f] != f:
            f = part[f]
        return f

    for a, b in combinations(real, 2):
        if (a ^ b).bit_count() <= 3:
            part[root(a)] = root(b)
    least = {}
    for f, i in real.items():
        least[root(f)] = min(i, least.get(root(f), i))
    want = [(i, f"{f:016x}", least[root(f)] if i is not None else None) for i, f in prints]
    out = anchors.simhash_components(docs, block=block)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert len(set(least.values())) < len(real)
    assert anchors.simhash_components(docs.limit(0)).count() == 0 and periods.periodic_runs(docs.limit(0)).count() == 0
