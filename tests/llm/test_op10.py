import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import op10_suffix_dedup as op
from ledgerline.llm.op10_suffix_dedup import kasai, suffix_array, without_repeats


def brute(docs, length=100):
    """docs: (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                gone[k : k + length] = True
            seen.add(w)
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        left = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def words(rng, n):
    return " ".join(rng.choice(["alpha", "bé", "gamma", "délta", "x", "omega", "的"]) + str(rng.randint(0, 40)) for _ in range(n))


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(20):
        d = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 300))) * rng.randint(1, 3)
        order = suffix_array(np.frombuffer(d, np.uint8)).tolist()
        assert order == sorted(range(len(d)), key=lambda i: d[i:])
        got = kasai(np.frombuffer(d, np.uint8), np.array(order), 100)
        for k in range(1, len(d)):
            x, y = d[order[k - 1] :][:100], d[order[k] :][:100]
            assert got[k] == next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def corpus():
    rng = random.Random(5)
    docs = [(i, words(rng, rng.randint(0, 120))) for i in range(60)]
    passage = words(rng, 60)
    docs += [(100 + i, words(rng, 9) + passage[i % 7 :] + words(rng, 9)) for i in range(40)]
    docs += [(200 + i, docs[70][1]) for i in range(20)]
    docs += [(300, "a" * 5000), (301, "ab" * 400), (302, None), (303, ""), (304, words(rng, 30) * 5)]
    return docs


@pytest.mark.parametrize("shard", [1 << 19, 600])
def test_against_brute_force(spark, shard, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(op, "SHARD", shard)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert result(without_repeats(df)) == brute(docs)


def test_small_shards_locally():
    """A minimizer with more bytes than a shard: the shards are merged by binary search."""
    import pyarrow as pa

    rng = random.Random(2)
    base = bytes(rng.randrange(97, 123) for _ in range(130))
    rows = [(7, i, 0, 0, 31, base if i % 3 else bytes([i]) * 10 + base[10:]) for i in range(40)]

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            self.f = f
            return self

    old, op.SHARD = op.SHARD, 300
    try:
        f = op._shards(Frame(), 100).f
        names = ["least", "id", "th", "first", "n", "part"]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
        found = {(i, w) for b in f([batch]) for i, f0, n in zip(b["id"].to_pylist(), b["first"].to_pylist(), b["n"].to_pylist()) for w in range(f0, f0 + n)}
    finally:
        op.SHARD = old
    seen, want = set(), set()
    for _, i, _, _, n, part in rows:
        for w in range(n):
            if part[w : w + 100] in seen:
                want.add((i, w))
            seen.add(part[w : w + 100])
    assert found == want


def test_edge_cases(spark):
    t = "word " * 50
    rows = [(1, t, 0), (1, t, 1), (2, t, 2), (None, t, 3), (5, None, 4)]
    got = without_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.n_removed)
    assert len(got) == 5 and by[2] == [250] and by[1] == [250, 250] and by[5] == [0]
    assert by[None][0] < 250  # the null doc_id comes first; only its own repeats go
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("rows_a_batch,shard", [(10_000, 1 << 19), (1, 1 << 19), (1, 200)])
def test_repeated_row_keeps_its_text(spark, rows_a_batch, shard, monkeypatch):
    monkeypatch.setattr(op, "SHARD", shard)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        rng = random.Random(3)
        one, null = words(rng, 60), words(rng, 60)
        rows = [(1, one)] * 4 + [(None, null)] * 3 + [(2, words(rng, 60)), (3, one)]
        got = without_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 9
    for r in got:
        assert r.n_removed == (len(one.encode()) if r.doc_id == 3 else 0)
