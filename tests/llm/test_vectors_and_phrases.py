"""Centroids, neighbours and collocations against brute force on small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursewise.llm import centroids, collocations, nearest

ODD = [(900, None), (901, [None] * 64), (902, [float("nan")] * 64), (903, [float("inf")] + [0.0] * 63), (904, [1.0] * 63), (905, [1.0] * 65), (906, [])]


def brute_clusters(rows, clusters=8, rounds=10):
    vectors = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int).tolist()) for i, v in rows]
    by_hash = sorted(vectors, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in by_hash[:clusters]]

    def assign(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        at = [assign(v)[0] for _, v in vectors]
        for c in range(len(centres)):
            own = [v for (_, v), k in zip(vectors, at) if k == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *assign(v)) for i, v in vectors]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found)


def clustered(table, **settings):
    return sorted((str(r[0]), *r[1:]) for r in centroids.cluster(table, **settings).collect())


@pytest.mark.parametrize("chunk", (16_384, 7))
def test_centroids(spark, chunk):
    rng = np.random.default_rng(2)
    pool = rng.integers(-3, 4, (12, 64)) / 8  # few values, so dictionaries repeat and distances tie
    rows = [(i, pool[rng.integers(12)].tolist()) for i in range(120)] + [(200 + i, rng.normal(size=64).tolist()) for i in range(60)]
    rows += [(5, pool[0].tolist()), (5, pool[0].tolist()), (None, pool[1].tolist())]
    table = spark.createDataFrame(rows + ODD, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("clash")).repartition(3)
    assert clustered(table, chunk=chunk) == brute_clusters(rows)


def test_centroids_of_few_and_too_large_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    schema = "vec_id long, embedding array<double>"
    assert clustered(spark.createDataFrame(rows, schema)) == brute_clusters(rows)
    assert clustered(spark.createDataFrame(ODD, schema)) == []
    with pytest.raises(Exception, match="exceed a long"):
        clustered(spark.createDataFrame([(1, [1e12] * 64)], schema))


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    for vectors in (rng.integers(0, 9, (500, 64)), rng.integers(-(1 << 27), 1 << 27, (50, 64)), np.repeat(rng.integers(0, 9, (3, 64)), 40, 0)):
        entries, codes = centroids.encode(vectors)
        assert (np.concatenate([e[c] for e, c in zip(entries, codes, strict=True)], 1) == vectors).all()
    assert len(entries) == 64 // centroids.WIDTHS[0]  # vectors that repeat take the widest blocks


def brute_neighbours(rows, k):
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, set()).add(tuple(np.array(v, np.float32).astype(float)))
    out = []
    for q in [i for i in vectors if i % 100 == 0]:
        own = min(vectors[q])
        far = sorted(
            (min(float(np.sqrt(((np.array(own) - np.array(v)) ** 2).sum())) for v in vs if len(v) == len(own)), i)
            for i, vs in vectors.items()
            if i != q and any(len(v) == len(own) for v in vs)
        )
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(far[:k])]
    return sorted(out)


def test_nearest_is_exact_on_small_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)] + [(200 + i, [0.5] * 6) for i in range(40)]
    rows += [(200, [0.5] * 6), (100, [9.0] * 6), (300, [0.25, 1.0, 2.0]), (301, [0.25, 1.0, 2.5]), (400, [7.0])]
    odd = [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (600, [0.0] * 6), (None, [1.0] * 6), (700, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash")).withColumn("near", F.lit(1))
    got = sorted(tuple(r) for r in nearest.nearest(table, F.col("vec_id") % 100 == 0).collect())
    want = brute_neighbours(rows, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12)
    assert nearest.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_nearest_recall_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 100)
    monkeypatch.setattr(nearest, "BUCKET", 90)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * rng.normal(size=16)).tolist()) for i in range(2000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in nearest.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    points = np.array([v for _, v in rows])
    right = 0
    for q, found in got.items():
        far = np.sqrt(((points - points[q]) ** 2).sum(1))
        best = [i for i in np.argsort(far, kind="stable") if i != q][:10]
        right += len(set(best) & set(found))
        assert all(d == pytest.approx(far[i], rel=1e-12) for i, d in found.items()) and len(found) == 10
    assert len(got) == 40 and right >= 0.9 * 400


def test_huge_and_tiny_distances():
    import pyarrow as pa

    far = nearest.exact_distance(pa.array([[3e200, 0.0], [3e-200, 0.0]]), pa.array([[0.0, 4e200], [0.0, 4e-200]]))
    assert far == pytest.approx([5e200, 5e-200])


def brute_collocations(docs, longest=4, min_count=30, top=2000):
    out = []
    per_lang = {}
    for text, lang in docs:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            f = per_lang.setdefault(lang or "und", Counter())
            for m in range(1, longest + 1):
                f.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    for lang, f in per_lang.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and inside(q) for q, b in candidates.items()):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n, -s) for r, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("top", (2000, 3))
def test_collocations(spark, top):
    rng = np.random.default_rng(5)
    words = ["The", "the", "cat", "dog", "né", "漢字", "x.y", "run\tfast", "\U0001f600", "a"]
    docs = [(" ".join(rng.choice(words, rng.integers(0, 60))) + str(rng.choice(["", ", the cat ran\n", "!?"])), str(rng.choice(["en", "de"]))) for _ in range(150)]
    docs += [(None, "en"), ("", None), ("the cat " * 400, None), ("a b c d e " * 40, "en"), ("a b c d e " * 40, "en"), ("\x0b\x0c..", "fr"), ("w " * 30_000, "fr")]
    table = spark.createDataFrame(docs, "text string, lang string").withColumn("phrase", F.lit("clash")).withColumn("w0", F.lit(1)).repartition(5)
    got = sorted(tuple(r) for r in collocations.collocations(table, top=top).collect())
    assert got == brute_collocations(docs, top=top) and len(got) >= 9
    assert collocations.collocations(table.limit(0)).count() == 0
