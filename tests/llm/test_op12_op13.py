"""op12 and op13 against brute force."""

import hashlib
import math

import numpy as np
import pytest

from ledgerline.llm.op12_heap_clustering import clustered, first_centroids, rescanned, started, whole
from ledgerline.llm.op13_fill_in_middle import boundaries, fitted, framed, restored, transformed

VECTORS = "vec_id long, embedding array<double>"


def kmeans(rows, k, rounds, dim):
    """Plain k-means over Python's whole numbers: (vec_id, cluster, distance), inertia, centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    return out, sum(d for _, _, d in out), cs


def blobs(n, dim, seed=1):
    """Groups of vectors, grid points with many ties, copies, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(i, (centres[i % 6] + rng.normal(size=dim) * 0.1).tolist()) for i in range(n)]
    rows += [(n + i, [float((i >> j) & 1) for j in range(dim)]) for i in range(16)]
    rows += [(5000 + i, [0.25] * dim) for i in range(20)] + [(5000, [0.25] * dim)] * 3
    return rows + [(9001, None), (9002, [1.0] * (dim + 1)), (9003, [None] + [0.0] * (dim - 1)), (9004, [math.nan] * dim), (9005, [math.inf] * dim), (9006, []), (None, [0.5] * dim)]


@pytest.mark.parametrize("k,rounds", [(8, 5), (1, 2), (60, 3), (8, 0)])
def test_clusters_are_those_of_plain_kmeans(spark, k, rounds):
    rows = blobs(300, 4)
    got = clustered(spark.createDataFrame(rows, VECTORS).repartition(3), k, rounds, 4).collect()
    want, inertia, cs = kmeans(rows, k, rounds, 4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    assert {r.inertia for r in got} == {inertia}
    for r in got:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)


def test_large_components_and_clashing_columns(spark):
    rows = [(i, [float(i % 7) * 4e4, -5e3 * i]) for i in range(50)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"{VECTORS}, cluster string, distance int")
    got = clustered(df, 5, 4, 2)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect()) == sorted(kmeans(rows, 5, 4, 2)[0])
    assert clustered(spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 0.0])], VECTORS), 1, 1, 2).count() == 2


def test_no_vectors(spark):
    assert clustered(spark.createDataFrame([], VECTORS), 3, 2, 4).count() == 0
    assert clustered(spark.createDataFrame([(1, None)], VECTORS), 3, 2, 4).count() == 0


def test_only_expired_gaps_are_scanned(spark):
    rows = whole(spark.createDataFrame(blobs(600, 4), VECTORS), 4, 256)
    c = first_centroids(rows, 6, "2:")
    blocks = started(rows, c)
    n = rows.count()
    assert blocks.selectExpr("sum(scanned)").first()[0] == n
    assert rescanned(blocks, c, [-1e18] * 6).selectExpr("sum(scanned)").first()[0] == 0
    some = rescanned(blocks, c, [20.0] * 6).selectExpr("sum(scanned)").first()[0]
    assert 0 < some < n


TEXTS = ["", "a", "Hello world", "èé" * 400 + "abc" * 300 + "漢字かな" * 500, "x" * 5000 + "🎈" * 3000 + "é" * 4000 + "y", "the <P> mark", "<S", "a<M>", " \n\t ", "one  two\nthree ", " x y é", "ab" * 100_000]


@pytest.mark.parametrize("error", [1, 7, 100, 127])
@pytest.mark.parametrize("unit", ["char", "word"])
def test_index_gives_every_boundary(error, unit):
    for text in TEXTS[:-1]:
        offsets = boundaries(text.encode(), unit)
        index = fitted(offsets, error)
        assert [index.offset(r) for r in range(len(offsets))] == offsets.tolist()
        assert np.abs(index.residuals.astype(int)).max() <= error
    assert len(fitted(boundaries(("ab" * 100_000).encode()), error).first) == 1
    assert len(fitted(np.cumsum(np.random.default_rng(3).integers(1, 60, 5000)), error).first) > 1


def test_units_are_code_points_or_words():
    assert boundaries("aé漢🎈".encode()).tolist() == [0, 1, 3, 6, 10]
    text = b" one  two\nthree "
    cuts = boundaries(text, "word").tolist()
    assert [text[a:b] for a, b in zip(cuts, cuts[1:])] == [b" one", b"  two", b"\nthree "]


def brute(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_texts_are_cut_as_by_brute_force(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(120)] + [(3, TEXTS[3])] * 2 + [(None, "null id"), (-5, "minus"), (500, None)]
    df = spark.createDataFrame([(i, t, 7, "o") for i, t in rows], "doc_id long, text string, n int, output string").repartition(4)
    got = transformed(df).collect()
    want = [brute(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    of = dict(rows)
    for r in got:
        assert r.restored == (of[r.doc_id] or "") and r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
    assert transformed(df.limit(0)).count() == 0


def test_parts_that_end_like_markers_come_back():
    ends = ["", "<", "<P", "<S", "<M", ">", "P>", "S>", "M>", "x<S<"]
    for p in ends:
        for m in ends:
            for s in ends:
                text = p + m + s
                if not any(x in text for x in ("<P>", "<S>", "<M>")):
                    for form in ("plain", "psm", "spm"):
                        assert restored(framed(form, p.encode(), m.encode(), s.encode()), form).decode() == text


def test_words_as_units(spark):
    got = transformed(spark.createDataFrame([(i, "uno due  tre\nquattro é cinque ") for i in range(40)], "doc_id long, text string"), "word").collect()
    assert all(r.restored == "uno due  tre\nquattro é cinque " and r.n == 6 for r in got)
    with pytest.raises(ValueError):
        transformed(spark.range(1), "line")
