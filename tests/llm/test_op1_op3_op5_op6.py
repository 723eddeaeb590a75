import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerline.llm import queries
from ledgerline.llm.op1_packing import packed, ranked, solved
from ledgerline.llm.op3_minhash import near_duplicates, registers
from ledgerline.llm import op5_stream_dedup as op5
from ledgerline.llm.op5_stream_dedup import exact_duplicates
from ledgerline.llm.op6_mixing import mixed


def words(rng, n):
    return " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randint(0, 99)) for _ in range(n))


# --- packing


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_packing(spark, vocabulary):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    docs = [(i, words(rng, rng.randint(0, 60))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, " \t\n "), (103, "It's ΑΣ  ΣΑΣ x\x1cy é é 的字 <|endoftext|>z 12345"), (104, "x" * 3000), (105, words(rng, 900)), (7, docs[7][1]), (None, "null id")]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, length int").repartition(5)
    rows = packed(df, vocabulary, 128).collect()
    encoder = Tokenizer.from_file(vocabulary)
    want = Counter()
    for d, t in docs:
        ids = [*encoder.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 128):
            part = ids[k : k + 128]
            want[d, k // 128, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 128
    total = sum(r.length for r in rows)
    assert len(seqs) <= -(-total // 128) + 2
    assert packed(spark.createDataFrame([], "doc_id long, text string"), vocabulary).count() == 0


def optimum(items, capacity):
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    """Bins that dominance fixes leave an instance whose optimum and theirs add up to the whole optimum."""
    from ledgerline.llm.op1_packing import reduced

    rng, sizes = random.Random(4), Counter()
    for _ in range(600):
        least, most = rng.choice([(1, 12), (2, 7), (3, 9), (1, 6)])
        items = sorted((rng.randint(least, most) for _ in range(rng.randint(0, 9))), reverse=True)
        left = Counter(items)
        fixed = reduced(left, 12)
        sizes.update(len(b) for b, _ in fixed)
        n = sum(m for _, m in fixed)
        rest = sorted((+left).elements(), reverse=True)
        assert n + (optimum(rest, 12) if rest else 0) == (optimum(items, 12) if items else 0)
        bins = solved(Counter(items), 12)
        assert all(sum(b) <= 12 for b, _ in bins)
        assert sorted(x for b, m in bins for _ in range(m) for x in b) == sorted(items)
        assert bins[: len(fixed)] == fixed  # what dominance fixes stays in the result
    assert min(sizes[1], sizes[2], sizes[3]) > 50 and set(sizes) == {1, 2, 3}


def test_ranks(spark):
    df = spark.createDataFrame([(i, 0, 0, 1 + i % 2, 5) for i in range(500)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = ranked(df).collect()
    for x in (1, 2):
        assert sorted(r.rank for r in got if r.length == x) == list(range(250))


# --- near duplicates


def brute_links(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets.items():
        for b, t in sets.items():
            if a < b and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i, _ in docs}


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        j = rng.randrange(len(w))
        op = rng.randrange(3)
        if op == 0:
            w[j] = rng.choice("xyz") + str(rng.randint(0, 10**6))
        elif op == 1 and len(w) > 1:
            del w[j]
        else:
            w.insert(j, "new" + str(rng.randint(0, 10**6)))
    return " ".join(w)


def near_corpus():
    rng = random.Random(8)
    docs = [(i, words(rng, rng.randint(0, 80))) for i in range(80)]
    base = words(rng, 150)
    docs += [(1000 - i, edited(rng, base, rng.randint(0, 9))) for i in range(120)]
    chain = words(rng, 200)
    for i in range(30):  # each like the one before, the ends unlike
        docs.append((2000 + (i * 7) % 30, chain))
        chain = edited(rng, chain, 3)
    for i in range(40):
        docs.append((3000 + i, edited(rng, "one two three four five six seven eight", rng.randint(0, 1))))
    docs += [(4000 + i, docs[90][1].upper() if i % 2 else docs[90][1]) for i in range(30)]
    return docs + [(5000, None), (5001, ""), (5002, " \n"), (5003, "One two"), (5004, "one\ttwo"), (5005, "x " * 5000)]


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (5, 80), (3, 90)])
def test_near_duplicates_against_brute_force(spark, k, percent):
    docs = near_corpus()
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_links(docs, k, percent)


def test_near_duplicates_edge_cases(spark):
    t = "a b c d e f g h"
    rows = [(1, t, "x"), (1, t, "y"), (2, t, "z"), (None, t, "n"), (3, None, "e")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registers_estimate_similarity():
    from ledgerline.llm.op3_minhash import estimated

    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        js = []
        for _ in range(60):
            common = rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2)
            c = int(2000 * share)
            pool = rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            a = np.unique(np.concatenate([common[:c], pool[:500]]))
            b = np.unique(np.concatenate([common[:c], pool[500:1000]]))
            j, high = estimated(registers(a), registers(b), len(a), len(b))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert high >= true
            js.append(j - true)
        assert abs(np.mean(js)) < 0.02


# --- exact duplicates


def same(df, sql, tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    want = con.execute(sql)
    cols = [d[0] for d in want.description]
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(df.select(cols).collect(), key=key) == sorted(want.fetchall(), key=key)


def test_exact_duplicates(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, rng.choice(["a", "b ", "b", "A", "", "long " * 900, None, "é", "é"]), "x") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, digest string")
    df.repartition(4).write.parquet(f"{tmp_path}/docs.parquet")
    import pandas as pd

    same(exact_duplicates(spark, f"{tmp_path}/docs.parquet"), queries.ORACLE_SQL["op5_exact_duplicates"], {"documents": pd.DataFrame(docs, columns=["doc_id", "text", "digest"])})


def test_exact_duplicates_edge_cases(spark, tmp_path):
    rows = [(4, "t"), (4, "t"), (None, "t"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d.parquet")
    got = exact_duplicates(spark, f"{tmp_path}/d.parquet").collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [(0, 0, 1, True), (0, 4, 3, False), (4, 4, 3, False), (4, 4, 3, True)]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e.parquet")
    assert exact_duplicates(spark, f"{tmp_path}/e.parquet").count() == 0


def test_exact_duplicates_state_goes_on(spark, tmp_path):
    long = "very long " * 200_000
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, long)], "doc_id long, text string").coalesce(1)
    first.write.parquet(f"{tmp_path}/d.parquet")
    got = exact_duplicates(spark, f"{tmp_path}/d.parquet/", f"{tmp_path}/state")
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got.collect()) == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    spark.createDataFrame([(7, "a"), (8, "c"), (9, long)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d.parquet")
    got = exact_duplicates(spark, f"{tmp_path}/d.parquet", f"{tmp_path}/state")
    want = [(1, 7, 2), (2, 2, 1), (3, 9, 2), (7, 7, 2), (8, 8, 1), (9, 9, 2)]
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got.collect()) == want
    batches = [spark.read.parquet(f"{tmp_path}/state/changes/batch={n}").agg({"group_size": "sum"}).first()[0] for n in (0, 1)]
    assert batches == [3, 5]  # the second batch read the new file only: two groups of two and one new row


def test_exact_duplicates_of_one_digest_and_other_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op5, "digested", lambda rows: rows.selectExpr("substr(sha2(text, 256), 1, 1) digest", f"{op5._LOCATOR} place", "text"))
    rows = [(i, f"text {i % 50}") for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d.parquet")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(spark, f"{tmp_path}/d.parquet").collect()}
    last = {t: max(i for i, x in rows if x == t) for _, t in rows}
    assert got == {i: (last[t], sum(x == t for _, x in rows), last[t] == i) for i, t in rows}


# --- mixing


def test_mixing(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(["w"] * rng.randint(0, 30)) + rng.choice(["", " ", "\n", " x"]), rng.choice(["a", "b", "B", "é", None, "z"] + ["hot"] * 6)) for i in range(600)]
    docs += [(9000, None, "tiny"), (9001, "one", "wee"), (9002, "\x85 a b", "zz")]
    import pandas as pd

    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = mixed(df).select("doc_id", "size", "source_size", "target", "taken")
    rows = got.collect()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "source"]).astype({"source": object}))
    want = {r[0]: r[1:] for r in con.execute(queries.ORACLE_SQL["op6_mix_sources"]).fetchall()}
    for r in rows:
        w = want[r.doc_id]
        assert (r.size, r.source_size, r.taken) == (w[0], w[1], w[3]) and r.target == pytest.approx(w[2])
        assert r["size"] == len([x for x in (dict((d[0], d[1]) for d in docs)[r.doc_id] or "").encode().split()])
    source = {d[0]: d[2] for d in docs}
    total = sum(r["size"] for r in rows)
    per = {}
    for r in rows:
        t = per.setdefault(source[r.doc_id], [r.target, 0, r.source_size])
        t[1] += r.taken
        assert r.taken <= 3 * r["size"]
    assert sum(t[0] for t in per.values()) == pytest.approx(total)
    assert all(abs(t[0] - t[1]) <= 1 and t[0] <= 3 * t[2] + 1e-6 for t in per.values())


def test_mixing_edge_cases(spark):
    assert mixed(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    rows = [(1, "a b", "s", 5, "k"), (1, "a b", "s", 6, "k"), (None, None, None, 7, "k")]
    got = mixed(spark.createDataFrame(rows, "doc_id long, text string, source string, size int, _k string")).collect()
    assert sorted((r["size"], r.taken) for r in got) == [(0, 0), (2, 2), (2, 2)]
