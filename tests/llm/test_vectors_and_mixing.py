"""Clustering, whitening and mixing against brute force on small tables with odd rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrace.llm import clustering, mixing, queries, vectors, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, x string, cluster string, n string, entry string"


def usable(e, dim=64):
    return e is not None and len(e) == dim and all(c is not None and math.isfinite(c) for c in e)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(5)
    plain = rng.normal(0, 0.2, (120, 64)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(plain)] + [(i, plain[3]) for i in range(200, 260)]
    rows += [(7, plain[8]), (7, plain[7]), (None, plain[9]), (-5, [0.0] * 64)]
    rows += [(300, None), (301, []), (302, plain[0][:63]), (303, [*plain[0], 0.5]), (304, [*plain[0][:63], None]), (305, [*plain[0][:63], float("nan")]), (306, [float("-inf"), *plain[0][1:]])]
    return spark.createDataFrame([(i, e, "x", "x", "x", "x") for i, e in rows], VECTORS).cache(), rows


def lloyd(rows, k=8, rounds=10):
    """All distances over all dimensions, with Python's whole numbers."""
    kept = [(i, [math.floor(1024 * c) for c in np.array(e, np.float32).astype(float).tolist()]) for i, e in rows if usable(e)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        centroids = [[sum(col) // len(members[j]) for col in zip(*members[j])] if members[j] else c for j, c in enumerate(centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    sums = Counter()
    for _, j, d in found:
        sums[j] += d
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, sums[j], sum(sums.values()), prints[j]) for i, j, d in found)


def test_clustering_against_brute_force(spark, odd_vectors):
    table, rows = odd_vectors
    assert Counter(map(tuple, clustering.cluster(table).collect())) == lloyd(rows)
    few = [r for r in rows if r[0] in (1, 2, 300)]
    assert Counter(map(tuple, clustering.cluster(table.where("vec_id in (1, 2, 300)")).collect())) == lloyd(few)
    none = clustering.cluster(table.where("false"))
    assert none.count() == 0 and none.columns == clustering.cluster(table).columns
    whole = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    assert Counter(map(tuple, queries.op11_centroid_clustering(spark, SF).collect())) == lloyd(whole)


def test_nearest_sees_ties_and_any_order():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, c = rng.integers(-3, 4, (200, 64)), rng.integers(-3, 4, (8, 64))
        c[5], c[6] = c[2], c[1]
        x[:40] = c[rng.integers(0, 8, 40)]
        x[40:80] = (c[0] + c[1]) // 2
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        which, best = clustering.nearest(x, c, rng.permutation(64))
        assert (which == d.argmin(1)).all() and (best == d.min(1)).all()


def test_numbers_out_of_bounds_raise(spark):
    with pytest.raises(Exception, match="exceeds"):
        vectors.whole_numbers(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>"), 64).collect()


def plainly_whitened(rows, out):
    """Holds rows of whiten() against all eigenvectors by numpy and sums by Python's whole numbers."""
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in np.array(e, np.float32).astype(float).tolist()]) for i, e in rows if usable(e)]
    n, sums = len(kept), [sum(col) for col in zip(*(v for _, v in kept))]
    y = np.array([[a - s / n for a, s in zip(v, sums)] for _, v in kept])
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1][:8], basis[:, ::-1][:, :8]
    found = defaultdict(list)
    for r in out:
        found[r["component"]].append(r)
    assert sorted(found) == list(range(1, 9)) and all(len(v) == n for v in found.values())
    deviations = Counter((i, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in kept)
    for k in range(8):
        assert Counter((r["vec_id"], int(r["deviation"])) for r in found[k + 1]) == deviations
        expected, by_deviation = y @ basis[:, k] / np.sqrt(values[k]), {}
        for (i, v), w in zip(kept, expected):
            by_deviation[i, sum((n * a - s) ** 2 for a, s in zip(v, sums))] = w
        pairs = [(r["whitened"], by_deviation[r["vec_id"], int(r["deviation"])]) for r in found[k + 1]]
        sign = 1 if sum(a * b for a, b in pairs) > 0 else -1
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-8
        assert {r["n"] for r in found[k + 1]} == {n} and all(abs(r["explained"] / (values[k] / (y * y).sum() * n) - 1) < 1e-10 for r in found[k + 1][:3])
    assert all(r["identity_error"] < 1e-10 for r in out) and len({r["identity_error"] for r in out}) == 1


def test_whitening_against_eigenvectors(spark, odd_vectors):
    table, rows = odd_vectors
    plainly_whitened(rows, whitening.whiten(table).collect())
    whole = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    out = queries.op12_whitening(spark, SF)
    assert dict(out.dtypes)["deviation"] == "bigint"
    plainly_whitened(whole, out.collect())


def test_whitening_expands_only_when_residuals_fail(spark, odd_vectors):
    table, _ = odd_vectors
    assert whitening.fit(vectors.whole_numbers(table, 64)).expanded
    rng = np.random.default_rng(1)
    flat = rng.normal(0, 0.2, (90, 64))
    flat[:, 12:] = 0.25  # rows vary along 12 dimensions, which 16 directions hold
    x = vectors.whole_numbers(spark.createDataFrame([(i, v) for i, v in enumerate(flat.tolist())], "vec_id long, embedding array<double>"), 64)
    model = whitening.fit(x)
    m = np.array([r["x"] for r in x.collect()], float)
    expected = np.linalg.eigvalsh(np.cov(m.T, bias=True))[::-1][:8]
    assert not model.expanded and np.allclose(model.values, expected, rtol=1e-12) and whitening.checked(x, model).identity_error < 1e-10


def test_whitening_without_variance(spark, odd_vectors):
    table, rows = odd_vectors
    assert whitening.whiten(table.where("false")).count() == 0
    same = whitening.whiten(table.where("vec_id between 200 and 220")).collect()
    assert len(same) == 21 * 8 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(21, 0, None, None, None)}
    two = whitening.whiten(table.where("vec_id in (1, 2)")).collect()
    assert {(r["component"], r["whitened"] is None) for r in two} == {(k, k > 1) for k in range(1, 9)} and all(abs(abs(r["whitened"]) - 1) < 1e-9 for r in two if r["component"] == 1)
    far = whitening.Centre(10**12, (3 * 10**17,) * 64, (0,) * 64, (10**6,) * 64)
    x = np.arange(64).reshape(1, 64)
    assert far.deviations(x) == [sum((10**12 * v - 3 * 10**17) ** 2 for v in range(64))]


def word_count(text):
    return len((text or "").encode().split())


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again, as fractions would have it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    held, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        shares = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s] + 1e-9]
        if not over:
            return held | shares
        for s in over:
            held[s] = float(most * sizes[s])
            left -= held[s]
            free.discard(s)
    return held


def odd_documents(spark):
    rng = random.Random(4)
    text = lambda n: " ".join("ab" for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), "hot" if i % 3 else f"s{i % 11}") for i in range(400)]
    rows += [(900, None, "a"), (901, "", "a"), (902, " \n\t\x0b", "b"), (903, text(40_000), "é"), (904, text(3), None), (None, text(9), None), (None, None, None), (5, text(30), "hot"), (5, text(30), "hot"), (6, "x\xa0y z w\x1c", "nothing else"), (907, None, "empty")]
    return spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], "doc_id long, text string, source string, size string, target string, src string, slot int"), rows


def test_word_counts(spark):
    texts = [None, "", " ", "\n\t\x0b\x0c\r ", "a", " a ", "a b", "a\xa0b", "a\x1cb \x85 c", "日本 x", "\U0001f600 \U0001f600", " a\n\nb\tc "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.n_words(df["text"])).collect()] == [word_count(t) for t in texts]


def test_mixing_against_brute_force(spark):
    table, rows = odd_documents(spark)
    placed, sources, mix = mixing.plan(table, block=32)
    out = mixing.totals(placed, sources, mix).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, word_count(t)) for i, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += word_count(t)
    expected, number = filled(sizes), {r["src"]: r["source"] for r in sources.collect()}
    assert [number[k] for k in sorted(number)] == [*sorted((s for s in sizes if s is not None), key=lambda s: s.encode()), None]
    for r in sources.collect():
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - expected[r["source"]]) < 1e-6 and abs(r["taken"] - r["target"]) <= 0.5
    got, pieces = Counter(), mix.collect()
    for p in pieces:
        got[p["src"]] += p["length"]
    assert all(got[r["src"]] == r["taken"] for r in sources.collect())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out) and sum(r["taken"] for r in out) == sum(got.values())
    # a block is whole, but for the last of a source; its pieces follow one another within documents
    blocks, last = defaultdict(int), {r["src"]: r["blocks"] - 1 for r in sources.collect()}
    for p in pieces:
        blocks[p["src"], p["block"]] += p["length"]
    assert all(n == 32 or b == last[s] for (s, b), n in blocks.items()) and {s: max(b for t, b in blocks if t == s) for s, _ in blocks} == {s: b for s, b in last.items() if b >= 0}
    again = [tuple(r) for r in mixing.totals(*mixing.plan(table.repartition(7), block=32)).collect()]
    assert Counter(again) == Counter(map(tuple, out))


def test_schedule_is_even(spark):
    table, _ = odd_documents(spark)
    _, sources, mix = mixing.plan(table, block=32)
    slots = {r["slot"]: (r["src"], r["block"]) for r in mix.select("slot", "src", "block").distinct().collect()}
    blocks = {r["src"]: r["blocks"] for r in sources.collect()}
    n = sum(blocks.values())
    assert len(slots) == n == len(set(slots.values()))
    had = Counter()
    for i, slot in enumerate(sorted(slots), 1):
        src, block = slots[slot]
        assert block == had[src]  # a source's blocks come in their order
        had[src] += 1
        assert all(abs(had[s] - i * blocks[s] / n) < 6 for s in blocks)


def test_mixing_of_nothing(spark):
    table, _ = odd_documents(spark)
    assert mixing.totals(*mixing.plan(table.where("false"))).count() == 0
    wordless = mixing.totals(*mixing.plan(table.where("doc_id in (900, 901, 902, 907)"))).collect()
    assert len(wordless) == 4 and {tuple(r)[1:] for r in wordless} == {(0, 0, 0.0, 0)}
