"""op11 against brute force: counts, a plain network in doubles, gradients by differences, and held-out likelihood."""

import math
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest

from ledgerline.llm import gru, op11_gated_scoring as op11
from ledgerline.llm.op11_gated_scoring import log_likelihoods, open_class, vocabulary, words_of

COUNTS = np.array([90, 70, 30, 30, 12, 9, 5, 5, 2, 1], float)


def network(seed=2, hidden=5, open_=3, classes=3, counts=COUNTS):
    s = gru.shape(counts, open_, classes)
    p = gru.initial(s, hidden, counts, np.array([8.0, 3.0, 0.0][:open_]))
    rng = np.random.default_rng(seed)
    return s, {k: (v + rng.normal(0, 0.4, v.shape)).astype(np.float32) for k, v in p.items()}


def plain(p, s, types, state=None, lead=None):
    """Log probabilities of one text, a token after the other, in doubles; and the last state."""
    q = {k: v.astype(np.float64) for k, v in p.items()}
    h = np.zeros(q["un"].shape[0]) if state is None else state
    n, out, before = len(h), [], s.own + s.open if lead is None else lead
    for x in types:
        g = 1 / (1 + np.exp(-(q["xg"][before] + h @ q["ug"])))
        c = np.tanh(q["xn"][before] + g[n:] * (h @ q["un"]))
        h = c + g[:n] * (h - c)
        a = h @ q["c"] + q["cb"]
        cls = int(s.class_of(np.array([x]))[0])
        lp = a[cls] - np.log(np.exp(a).sum())
        if x < s.own:
            lo, hi = s.starts[cls], s.starts[cls + 1]
            w = q["w"][lo:hi] @ h + q["wb"][lo:hi]
            lp += w[x - lo] - np.log(np.exp(w).sum())
        out.append(lp)
        before = x
    return np.array(out), h


def some_texts(s, n=40, longest=90, seed=0):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, s.own + s.open, rng.integers(1, longest)).astype(np.int32) for _ in range(n)]


@pytest.mark.parametrize("most", [1, 3, 512])
def test_scores_are_those_of_the_plain_network(most):
    s, p = network()
    own = some_texts(s)
    want = [plain(p, s, t)[0].sum() for t in own]
    assert np.allclose(gru.scored(p, s, own, most), want, rtol=1e-4, atol=1e-3)


@pytest.mark.parametrize("counts", [COUNTS, COUNTS[:1], COUNTS[:0]])
def test_probabilities_of_all_types_sum_to_one(counts):
    s, p = network(counts=counts)
    context = some_texts(s, 1, 30)[0].tolist()
    total = sum(math.exp(plain(p, s, [*context, x])[0][-1]) for x in range(s.own + s.open))
    assert total == pytest.approx(1)
    both = [np.array([*context, x], np.int32) for x in range(s.own + s.open)] + [np.array(context, np.int32)]
    got = gru.scored(p, s, both)
    assert np.exp(got[:-1] - got[-1]).sum() == pytest.approx(1, rel=1e-3)


def test_gradients_are_those_of_differences(monkeypatch):
    """One window of two slots with a fresh start inside: every parameter's gradient by central differences."""
    s, p = network()
    texts = [np.array([0, 11, 3, 7, 12, 2, 2, 5, 9, 10], np.int32), np.array([1, 4, 6], np.int32), np.array([8, 0, 12, 1, 3], np.int32)]
    start = np.full(3, s.own + s.open)
    seen = {}

    def keep(self, k, at, g, scale):
        seen.setdefault(k, np.zeros_like(self.p[k]))[at] += g

    monkeypatch.setattr(gru.Learner, "_step", keep)
    learner = gru.Learner(p, s, 2)
    learner.learn(gru.Streams(texts, start, 2))
    rng = np.random.default_rng(4)

    def loss(q):
        return -sum(plain(q, s, t)[0].sum() for t in texts)

    for k in p:
        for _ in range(6):
            i = tuple(rng.integers(0, n) for n in p[k].shape)
            both = []
            for e in (1e-3, -1e-3):
                q = {n: v.astype(np.float64) for n, v in p.items()}
                q[k][i] += e
                both.append(loss(q))
            assert seen[k][i] == pytest.approx((both[0] - both[1]) / 2e-3, rel=0.02, abs=2e-3), (k, i)


def test_streams_hold_every_token_once():
    s, _ = network()
    own = some_texts(s, 23, 200, 5)
    for most in (1, 4, 64):
        streams = gru.Streams(own, np.full(len(own), 99), most)
        got = [[] for _ in own]
        for at, filled in streams.windows():
            for t in range(at.shape[0]):
                for i in range(at.shape[1]):
                    if filled[t, i]:
                        place = at[t, i]
                        got[streams.text[place]].append((int(streams.inputs[place]), int(streams.types[place]), bool(streams.fresh[place])))
        for t, rows in zip(own, got):
            assert [r[1] for r in rows] == t.tolist() and [r[0] for r in rows] == [99, *t[:-1].tolist()] and [r[2] for r in rows] == [True] + [False] * (len(t) - 1)


def test_training_lowers_the_loss():
    s, _ = network()
    p = gru.initial(s, 8, COUNTS, np.array([8.0, 3.0, 0.0]))
    own = [np.tile(np.array([0, 3, 11, 5], np.int32), 40) for _ in range(64)]
    assert gru.scored(gru.learned(p, s, own), s, own[:2]).mean() > gru.scored(p, s, own[:2]).mean() + 40


def brute(rows, fold=7, held=2):
    training = Counter()
    held_out = [crc32(("" if i is None else str(i)).encode()) % fold == held for i, _ in rows]
    for (_, t), out in zip(rows, held_out):
        if not out:
            training.update(words_of((t or "").encode()))
    n, v = sum(training.values()), len(training)
    told = []
    for (i, t), out in zip(rows, held_out):
        words = words_of((t or "").encode())
        told.append((i, out, len(words), sum(training[w] > 0 for w in words), n, sum(math.log10((training[w] + 1) / (n + v + 1)) for w in words)))
    return told, training


def equal(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r)[:6] for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) for g, w in zip(got, want))


def test_base_scores_and_held_out_likelihood(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    got = log_likelihoods(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    equal(got, brute(rows)[0])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_words_outside_of_the_head_and_odd_rows(spark, monkeypatch):
    """A small head, so that most words are joined; nulls, repeats, a hot word that only held-out texts have, a very long text."""
    monkeypatch.setattr(op11, "HEAD", 6)
    monkeypatch.setattr(op11, "OWN", 3)
    held = [i for i in range(400) if crc32(str(i).encode()) % 7 == 2]
    rows = [(i, f"The the word{i % 5} Common other{i} É x\tx\x0by") for i in range(200)]
    rows += [(i, "only here " * 50) for i in held[:10]] + [(3, "twice"), (3, "twice"), (None, "no id"), (401, None), (402, ""), (403, " \n "), (404, "long " * 60_000), (405, "w" * 5000)]
    df = spark.createDataFrame([(i, t, 1.0, b"x") for i, t in rows], "doc_id long, text string, score double, word binary").repartition(3)
    want, training = brute(rows)
    got = log_likelihoods(df).collect()
    equal(got, want)
    assert all(math.isfinite(r.score) for r in got)
    v = vocabulary(spark.createDataFrame([(bytearray(w), n) for w, n in training.items()], "word binary, n long"))
    order = sorted(training, key=lambda w: (-training[w], w))
    assert 3 <= len(v.words) <= 6 and v.words == order[: len(v.words)] and training[order[len(v.words)]] < training[v.words[-1]] and v.tokens == sum(training.values()) and v.distinct == len(training)
    rest = [w for w in training if w not in v.words[:3]]
    for k in range(op11.OPEN):
        assert v.open_words[k] == sum(open_class(w) == k for w in rest) and v.open_tokens[k] == sum(training[w] for w in rest if open_class(w) == k)


def test_operator_score_is_that_of_the_plain_network(spark, monkeypatch):
    """The parameters that the operator trained, put through the plain network over whole texts, give its scores."""
    monkeypatch.setattr(op11, "HEAD", 40)
    monkeypatch.setattr(op11, "OWN", 20)
    kept = []
    real = op11.trained
    monkeypatch.setattr(op11, "trained", lambda *a: kept.append((real(*a), a[1])) or kept[-1][0])
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.4, rng.integers(0, 120)), 300))) for i in range(150)]
    got = {r.doc_id: r for r in log_likelihoods(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    (p, v), training = kept[0], brute(rows)[1]
    s, place = v.shape(), {w: i for i, w in enumerate(v.words[: v.own])}
    for i, text in rows[::7]:
        words = words_of(text.encode())
        types = [place.get(w, v.own + open_class(w)) for w in words]
        total = plain(p, s, types)[0].sum() / math.log(10)
        total += sum(math.log10((training[w] + 1) / (v.open_tokens[open_class(w)] + v.open_words[open_class(w)] + 1)) for w in words if w not in place)
        assert got[i].score == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_all_training_texts_are_learned(spark, monkeypatch):
    """The rounds together learn every token of every training text, each once."""
    learned, real = [], op11.averaged

    def seen(replicas):
        learned.append(replicas.where("chunk = 0").agg({"tokens": "sum"}).first()[0] or 0)
        return real(replicas)

    monkeypatch.setattr(op11, "averaged", seen)
    rows = [(i, " ".join(f"w{k % 7}" for k in range(i % 11))) for i in range(200)]
    got = log_likelihoods(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(learned) == got[0].train_tokens == sum(r.n_tokens for r in got if not r.held_out)


def test_no_rows_and_no_training_rows(spark):
    assert log_likelihoods(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = [i for i in range(60) if crc32(str(i).encode()) % 7 == 2]
    got = log_likelihoods(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 3, 0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in got)
