import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import op4_line_dedup as lines_op
from ledgerline.llm.op2_language import family, features, identified, in_known_language
from ledgerline.llm.op4_line_dedup import deduplicated
from ledgerline.llm.op7_permutation_index import nearest

# --- language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_language_edge_cases(spark):
    de, en = "der hund und die katze " * 9, "the dog and the cat " * 9
    rows = [(i, de if i % 2 else en, "de" if i % 2 else "en", "z") for i in range(40)]
    rows += [(100, None, "de", ""), (101, "12 ?!", None, ""), (102, "", "en", ""), (None, de, None, ""), (103, en * 5000, None, ""), (103, en, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {}
    for r in identified(df).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.held_out))
    assert [got[i][0][0] for i in (100, 101, 102)] == ["und"] * 3
    assert got[None] == [("de", False)] and [x[0] for x in got[103]] == ["en", "en"]
    assert identified(df.where("false")).count() == 0
    assert {r.lang_pred for r in identified(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    one = identified(df.where("lang = 'de'")).collect()
    assert {r.lang_pred for r in one if r.doc_id != 100} == {"de"}
    kept = in_known_language(df)
    assert kept.columns == ["doc_id", "text", "lang"] and kept.count() == 43


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    foreign = [
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem i sumieniem",
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki ja omatunto",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        "QmFzZTY0IGlzIG5vdCBhIGxhbmd1YWdlLCBpdCBpcyBhbiBlbmNvZGluZyBvZiBieXRlcyBpbiA2NCBsZXR0ZXJz" * 4,
        "for (int i = 0; i < n; ++i) { buf[i] = tmp[i]; printf(fmt, idx, ptr); } return ctx->err; " * 3,
    ]
    short = ["the dog and the cat", "the anly and thon", "der und die ein", "les des une ou", "de la que en"]
    rows = [(10_000_000 + i, t, None) for i, t in enumerate(foreign)] + [(20_000_000 + i, t, None) for i, t in enumerate(short)]
    kept = {r.doc_id for r in in_known_language(docs.union(spark.createDataFrame(rows, docs.schema))).collect()}
    assert not kept & {10_000_000 + i for i in range(len(foreign))}
    assert kept >= {20_000_000 + i for i in range(len(short))}
    with_letters = {r.doc_id for r in docs.where("text RLIKE '\\\\p{L}'").collect()}
    assert len(kept & with_letters) >= 0.995 * len(with_letters)


def test_languages_are_held_against_all_labelled_rows(spark):
    # a way of writing that few labelled rows have, so that a small sample knows none of them
    rng = random.Random(1)
    often = lambda: " ".join(rng.choice(["der", "hund", "und", "die", "katze", "ein", "haus"]) for _ in range(60))
    seldom = lambda: " ".join(rng.choice(["\u4eba\u4eba", "\u751f\u800c", "\u81ea\u7531", "\u5c0a\u4e25"]) for _ in range(60))
    rows = [(i, seldom() if i % 40 == 7 else often(), "xx") for i in range(1200)]
    kept = {r.doc_id for r in in_known_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=4).collect()}
    assert kept == set(range(1200))


def test_families_and_features():
    assert family("en") == family("de-AT") == "germanic" and family("fr") == family("es") == "romance" and family("xx") == "only xx"
    assert np.linalg.norm(features(b"")) <= 1 and np.linalg.norm(features("é".encode())) == pytest.approx(1)
    long = b"abc de " * 200_000  # in blocks as in one piece
    assert np.allclose(features(long), features(long[: 7 * 1000]), atol=1e-2)


# --- lines


def words_of(line):
    import regex

    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ").split(" ")


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_corpus():
    rng = random.Random(9)
    pool = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randint(0, 99)}" for _ in range(300)]
    base = [" ".join(rng.choice(pool) for _ in range(n)) for n in (6, 12, 25, 40, 60, 80)]

    def line():
        t = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(pool)
        return rng.choice(["", " ", "- "]) + " ".join(t).capitalize() + rng.choice(["", "!", "."])

    docs = [(i, "\n".join(rng.choice([line, line, lambda: rng.choice(["", "***", "Short one.", "short   one"])])() for _ in range(rng.randint(1, 8)))) for i in range(90)]
    return docs + [(500, None), (501, ""), (502, "\n\n")]


def brute_groups(docs):
    """Normalised lines with words, in order of their places, and the root of each under all links of edit similarity alone."""
    places = {}
    for i, t in sorted((i, t) for i, t in docs if t):
        for p, x in enumerate(t.split("\n")):
            if (w := words_of(x)) != [""]:
                places.setdefault(tuple(w), []).append((i, p))
    root = {n: n for n in places}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ns = list(places)
    pairs = []
    for k, a in enumerate(ns):
        for b in ns[:k]:
            longest = max(len(a), len(b))
            if min(len(a), len(b)) >= lines_op.MIN_WORDS and edit(a, b) <= int(longest * (1 - lines_op.SIMILARITY) + 1e-9):
                pairs.append((a, b))
                root[find(a)] = find(b)
    return places, find, pairs


def test_lines_against_brute_force(spark):
    docs = line_corpus()
    places, find, pairs = brute_groups(docs)
    assert len(pairs) > 100
    first = {}
    for n, at in places.items():
        first[find(n)] = min(first.get(find(n), at[0]), min(at))
    want = dict.fromkeys((i for i, _ in docs), 0)
    for ats in places.values():
        for at in ats:
            want[at[0]] += at not in first.values()
    got = {r.doc_id: r for r in deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    assert len(got) == len(docs) and tuple(got[500])[1:] == (None, 0, 0)
    for i, t in docs:
        assert got[i].n_dropped <= want[i]  # a line that is dropped has a link
        if t:
            lines = iter(t.split("\n"))  # the lines kept are lines of the text, in order
            assert got[i].n_lines == len(t.split("\n")) and (not got[i].text or all(x in lines for x in got[i].text.split("\n")))
    assert sum(r.n_dropped for r in got.values()) >= 0.95 * sum(want.values())


def test_lines_recall_on_the_table(spark):
    """Of pairs of lines of edit similarity 0.8 or more, in words, at least 0.9 are in one group."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(4)
    lines = [x for _, t in docs if t for x in t.split("\n") if len(x.split()) >= 5]
    more = []
    for i, x in enumerate(rng.sample(lines, 150)):  # copies with up to a fifth of the words changed
        w = x.split()
        for k in rng.sample(range(len(w)), rng.randint(1, max(1, len(w) // 5))):
            w[k] = rng.choice(["changed", w[k][::-1] + "x", w[k] + "s"])
        more.append((10_000 + i, " ".join(w)))
    out = {r.doc_id: r.n_dropped for r in deduplicated(spark.createDataFrame(docs + more, "doc_id long, text string")).where("doc_id >= 10000").collect()}
    assert sum(out.values()) >= 0.9 * len(more)


def spread_pairs(rng, n, pairs):
    """Pairs of lines of n words, all of words of their own, of which exactly the fifth that may differ does, evenly spread."""
    for _ in range(pairs):
        a = [f"{rng.getrandbits(48):x}" for _ in range(n)]
        b, edits, at = list(a), n // 5, rng.random()
        for k in range(edits):
            b[int((k + at) * n / edits) % n] = f"{rng.getrandbits(48):x}"
        yield " ".join(a), " ".join(b)


def test_lines_recall_by_length(spark):
    """Of pairs at the threshold whose edits are spread evenly, at least 0.9 are linked at each length."""
    rng, rows, lengths = random.Random(14), [], (5, 6, 8, 10, 12, 15, 20, 30, 47, 50, 80, 200)
    for n in lengths:
        rows += [(2 * len(rows) + j, x, n) for pair in spread_pairs(rng, n, 100) for j, x in enumerate(pair)]
    rows = [(i, x, n) for i, (_, x, n) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = {r.n: r.dropped for r in deduplicated(df).groupBy("n").agg({"n_dropped": "sum"}).toDF("n", "dropped").collect()}
    assert {n: got[n] for n in lengths if got[n] < 90} == {}


def test_lines_of_few_words_and_of_neighbouring_lengths(spark):
    """Every line has keys, whatever its vocabulary; lengths on both sides of a limit meet."""
    rng, rows = random.Random(15), []
    for k in range(40):  # long lines of five distinct words, with one word changed
        some = [f"{rng.getrandbits(40):x}" for _ in range(5)]
        a = [rng.choice(some) for _ in range(60)]
        b = list(a)
        b[rng.randrange(60)] = "changed"
        rows += [" ".join(a), " ".join(b)]
    for n in (5, 6, 10, 11, 12, 13, 46, 47, 48):  # a word more
        for _ in range(10):
            a = [f"{rng.getrandbits(48):x}" for _ in range(n)]
            b = list(a)
            b.insert(rng.randrange(n + 1), "more")
            rows += [" ".join(a), " ".join(b)]
    out = deduplicated(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert out.where("n_dropped = 1 AND doc_id % 2 = 1").count() >= 0.97 * len(rows) / 2


def test_lines_lose_no_link(spark, monkeypatch):
    """Every link counts, also of lines that share runs with many others which have no link with them, and in blocks of several parts."""
    monkeypatch.setattr(lines_op, "PART", 3, raising=False)
    rng, rows = random.Random(16), []
    common = [f"common{i}" for i in range(14)]
    for _ in range(60):  # pairs: frequent words in front, words of their own behind, four of 20 changed, spread
        a = common + [f"{rng.getrandbits(40):x}" for _ in range(6)]
        b = list(a)
        for k in (2, 7, 12, 17):
            b[k] = f"{rng.getrandbits(40):x}"
        rows += [" ".join(a), " ".join(b)]
    for n in (5, 7, 9, 10, 14, 15, 20, 24, 25, 60):
        rows += [x for pair in spread_pairs(rng, n, 40) for x in pair]
    docs = list(enumerate(rows))
    places, find, _ = brute_groups(docs)
    first = {}
    for n, at in places.items():
        first[find(n)] = min(first.get(find(n), at[0]), min(at))
    want = {at[0] for ats in places.values() for at in ats if at not in first.values()}
    got = {r.doc_id for r in deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).where("n_dropped = 1").collect()}
    assert got == want


def test_lines_of_a_family_are_not_paired_all(spark, monkeypatch):
    """Near copies of one line, whose first is far from most, and long lines of the same words take few comparisons a line."""
    rng, made = random.Random(17), []
    word = lambda: f"{rng.getrandbits(40):x}"
    base, rows = [word() for _ in range(50)], []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(50), 9 if i == 0 else rng.randint(0, 8)):
            w[k] = word()
        rows.append(" ".join(w))
    shared, few = [word() for _ in range(4)], [word() for _ in range(40)]
    for _ in range(100):  # some of the words often, others once
        often = rng.sample(few, 8)
        w = few + [rng.choice(often) for _ in range(110)]
        rng.shuffle(w)
        rows.append(" ".join(w[:75] + shared + w[75:]))
    own = lines_op.verified
    monkeypatch.setattr(lines_op, "verified", lambda edges, once: made.append(edges.count()) or own(edges, once))
    docs = list(enumerate(rows))
    got = {r.doc_id for r in deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).where("n_dropped = 1").collect()}
    assert got == set(range(1, 400))  # a brute force gives the same
    assert sum(made) < 6 * len(rows)


def test_lines_compare_a_pair_once(spark, monkeypatch):
    """Runs that the same lines share are one block, and a pair that several blocks share comes from the first of them only; a
    pair of large components is not left out."""
    rng = random.Random(18)
    word = lambda: f"{rng.getrandbits(40):x}"
    base, texts = [word() for _ in range(30)], []
    texts += [" ".join([*base, *[word() for _ in range(20)]]) for _ in range(2)]  # 28 runs in common, and no others have them
    shared = [[word() for _ in range(4)] for _ in range(3)]
    texts += [" ".join(sum(([*x, *[word() for _ in range(3)]] for x in shared[: 1 + i % 3]), [])) for i in range(30)]
    once = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("th", F.lit(0))
    once = lines_op.hashed_lines(once).select(F.col("id").alias("node"), "n_words", "line").localCheckpoint()
    rows = lines_op.blocks(once).localCheckpoint()
    members = {}
    for r in rows.collect():
        members.setdefault(r.key, set()).add(r.node)
    assert sorted(map(len, members.values())) == sorted({frozenset(m): len(m) for m in members.values()}.values()) and {0, 1} in members.values()
    monkeypatch.setattr(lines_op, "_MAY_LINK", "true")
    for label in ("node", "CASE WHEN node % 3 = 0 THEN 5 ELSE node % 2 END"):
        groups = once.selectExpr("node", f"{label} component")
        of = {r.node: r.component for r in groups.collect()}
        # a pair with a block's least node was compared before
        want = {(a, b) for m in members.values() for a in m for b in m if a < b and of[a] != of[b]} - {(min(m), b) for m in members.values() for b in m}
        got = [(r.hub, r.node) for r in lines_op.remaining(rows, groups).collect()]
        assert sorted(got) == sorted(want) and len(want) > 5


def test_lines_leave_little_on_disk(spark, monkeypatch):
    """What was stored on the way to the links is gone when they are found, and so is what a stored frame shuffled."""
    import glob
    import os
    import time

    from ledgerline.llm import _common

    made = []
    own = lines_op.stored
    monkeypatch.setattr(lines_op, "stored", lambda df, name: made.append((name, own(df, name))) or made[-1][1])
    folders = lambda: {n for n, df in made for f in df.inputFiles()[:1] if glob.glob(f.removeprefix("file://").rsplit("/", 1)[0] + "/*.parquet")}
    assert deduplicated(spark.createDataFrame(line_corpus(), "doc_id long, text string")).count() == 93
    assert {"line-keys", "line-blocks", "line-edges", "links", "line-nodes"} <= {n for n, _ in made}
    assert folders() <= {"line-places", "distinct-lines", "line-groups"}

    local = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    names = lambda: {n for top in local for _, _, found in os.walk(top) for n in found}
    before = names()
    kept = spark.range(1000).repartition(3, "id")
    _common.stored(kept, "test")
    until = time.time() + 10
    while (left := {n for n in names() - before if n.startswith("shuffle")}) and time.time() < until:
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("times", [1, 18, 19, 60])
def test_simhash_counts_bits(spark, times):
    import pyspark.sql.functions as f

    words = ["alpha", "beta", "gamma", "delta", "alpha", "zeta", "eta"] * times
    row = spark.createDataFrame([(1, 2, words)], "a long, b long, w array<string>").select("a", "b", f.transform("w", lambda x: f.xxhash64(x)).alias("h"))
    r = lines_op.simhashes(row).first()
    h = [x & (2**64 - 1) for x in r.h]
    want = 0
    for k in range(lines_op.BITS):
        if 2 * sum((x >> k) & 1 for x in h) > len(words):
            want |= 1 << k
    assert r.sim == want


def test_lines_names_may_clash(spark):
    rows = [(1, "a line of seven words is here\nx", 5, "g", "t", None), (2, "a line of seven words is there", 6, "h", "u", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, gone string, th string, `n.dots` int")
    got = deduplicated(df)
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(*rows[0], 2, 0), (2, "", *rows[1][2:], 1, 1)]


def test_lines_edge_cases(spark):
    rows = [(1, "same line here\nx", "s"), (1, "same line here\nx", "t"), (2, "Same line, here!", "u"), (None, "x\n\n", "v"), (3, "one", "w"), (3, "two\none", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = deduplicated(df).collect()
    assert len(got) == 6 and [r.text for r in got if r.doc_id == 1] == ["same line here"] * 2
    assert [r.text for r in got if r.doc_id == 2] == [""] and [r.text for r in got if r.doc_id is None] == ["x\n\n"]
    assert sorted(r.text for r in got if r.doc_id == 3) in (["", "two\none"], ["one", "two"])
    assert deduplicated(df.where("false")).count() == 0
    long = " ".join(f"w{i}" for i in range(30_000))
    got = deduplicated(spark.createDataFrame([(1, long), (2, long + " end")], "doc_id long, text string")).collect()
    assert sorted(r.n_dropped for r in got) == [0, 1]


# --- nearest neighbours


def brute_nearest(rows, every=50, k=5):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in ok:
        if q % every == 0:
            s = sorted(((-float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), i) for i, b in ok if i != q))[:k]
            out[q] = [(i, -c) for c, i in s]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = sum(i in found.get(q, {}) for q, xs in want.items() for i, _ in xs)
    return hits / sum(len(x) for x in want.values())


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = nearest(table).collect()
    want = brute_nearest(rows)
    assert recall(got, want) >= 0.95
    assert {r.query_id for r in got} == set(want)
    for r in got:
        assert r.vec_id != r.query_id


def test_nearest_exact_on_few(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[50][1]) for i in range(200, 280)]  # copies of a query, queries among them
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0, None] * 4), (1004, [float("inf")] + [1.0] * 7), (1050, []), (None, rows[3][1]), (50, rows[50][1])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))).collect()
    want = brute_nearest(rows[:-1])
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {q: [i for i, _ in x] for q, x in by.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in by for a, b in zip(by[q], want[q]))
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    three = nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [2.0, 4.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(three, key=lambda r: r.rank)] == [(1, 2), (2, 1)]


def test_nearest_sends_no_copies_of_queries_through_the_driver(spark, monkeypatch):
    for name, value in (("BLOCK", 10), ("QUERY_BLOCK", 3)):
        monkeypatch.setattr(f"ledgerline.llm.op7_permutation_index.{name}", value)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = found.collect()
    joins = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Join [block" in x or "Join [group" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {q: [i for i, _ in x] for q, x in brute_nearest(rows).items()}


def test_nearest_ties_and_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])]
    rows += [(i, [0.5, 0.5, 0.5, 0.5] if i % 2 else [2.0**i, 2.0**i, 2.0**i, 2.0**i]) for i in range(1, 41)]  # one cosine, many vectors
    rows += [(100 + i, [-1e200 * float(x) for x in rng.random(4)]) for i in range(1, 8)]
    rows += [(50, [1e200, -1e200, 0.0, 0.0])]
    rows += [(1000 + i, (-rng.random(4)).tolist()) for i in range(1, 300)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert [got[0][k][0] for k in range(1, 6)] == [50, 1, 2, 3, 4]
    assert all(abs(got[0][k][1] - want) < 1e-12 for k, want in ((1, 2**-0.5), (2, 0.5), (5, 0.5)))
    v = {i: np.array(x) / max(map(abs, x)) for i, x in rows}
    want = sorted((-float(v[50] @ x / np.sqrt((v[50] @ v[50]) * (x @ x))), i) for i, x in v.items() if i != 50)[:5]
    assert [got[50][k][0] for k in range(1, 6)] == [i for _, i in want]
