"""Log-likelihood of whole texts by a gated recurrent language model.

Words are counted over all training texts and their counts stay distributed. The HEAD most frequent words reach every task;
the OWN most frequent of them are the network's own words. All other words are in OPEN classes by their last two bytes; the
network gives the class' probability in its context, and the counts a word's within its class: (count + 1) / (tokens of the
class + its distinct words + 1). A word outside of the head is joined with the distributed counts, so every token is scored
by its exact count, however many distinct words there are.

Training is by rounds: replicas, as many as the training tokens ask for, start from the same parameters, learn their own
texts by truncated backpropagation and are averaged by tokens. Every round takes other texts, all rounds take all of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress
from zlib import crc32

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import gru
from ledgerline.llm._common import removed, stored, texts

#: Words that reach every task, of at most LONGEST bytes each; the network's own words; their classes, and those of other words.
HEAD, LONGEST, OWN, CLASSES, OPEN = 1 << 17, 64, 1024, 24, 24
HIDDEN = 16
#: Training: rounds, each over its part of all training texts, and tokens of a replica in a round.
ROUNDS, REPLICA = 4, 100_000
#: Tokens that a task scores or learns at once, distinct words that it counts before it passes them on, floats in a row of parameters.
GROUP, COUNTED, CHUNK = 1_000_000, 200_000, 2048
#: The end of a text as a word; no word holds white space.
END = b" "


@dataclass(frozen=True)
class Vocabulary:
    """Head words by falling count, their counts; tokens and distinct words of each open class, and of all; the first words are the network's own."""

    words: list[bytes]
    counts: np.ndarray
    open_tokens: np.ndarray
    open_words: np.ndarray
    tokens: int
    distinct: int
    own: int

    def shape(self) -> gru.Shape:
        return gru.shape(self.counts[: self.own], OPEN, CLASSES)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": b"\n".join(self.words)}  # one value travels faster than a hundred thousand

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state | {"words": state["words"].split(b"\n") if len(state["counts"]) else []})


def open_class(word: bytes) -> int:
    return crc32(word[-2:]) % OPEN


class Encoder(dict):
    """Word to its place in the head; other words to -1 - their open class, which is not kept. What is known of either is in
    arrays by that number, as open classes stand at their ends in falling order."""

    def __init__(self, v: Vocabulary):
        super().__init__(zip(v.words, range(len(v.words)), strict=True))
        rest = np.array([open_class(w) for w in v.words[v.own :]], int)
        classes = np.arange(OPEN)
        size = np.log10(v.open_tokens + v.open_words + 1)
        counts = np.log10(v.counts + 1)
        self.type = np.concatenate([np.arange(v.own), v.own + rest, v.own + classes[::-1]]).astype(np.int32)
        self.log_count = np.concatenate([counts, np.zeros(OPEN)])
        self.within = np.concatenate([np.zeros(v.own), counts[v.own :] - size[rest], -size[::-1]])

    def __missing__(self, word: bytes) -> int:
        return -1 - open_class(word)

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def words_of(text: bytes) -> list[bytes]:
    """A text's words with A-Z as a-z, and its end."""
    words = text.lower().split()
    words.append(END)
    return words


def is_training(doc_id: Column, fold: int = 7, held: int = 2) -> Column:
    """Whether crc32 of the id as text leaves another remainder than the held-out one; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % fold != held


def counted(docs: DataFrame) -> DataFrame:
    """Rows (word binary, n) of all words and ends of docs."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def told(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"])

        seen: Counter = Counter()
        for batch in batches:
            for text in texts(batch):
                seen.update(words_of(text))
                if len(seen) >= COUNTED:
                    yield told(seen)
                    seen = Counter()
        if seen:
            yield told(seen)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _size(n: Column) -> Column:
    """Bucket of a count: itself up to 4095, then 256 buckets for each doubling; a larger count is in no smaller bucket."""
    return F.when(n < 4096, n).otherwise(4096 - 12 * 256 + F.floor(F.log2(n) * 256)).cast("int")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What reaches every task of counts (word, n): the most frequent words in whole buckets of counts, at most HEAD of at
    most LONGEST bytes, and sums over all. The driver gets a row a bucket, a row a class and the head."""
    short = counts.where(F.length("word") <= LONGEST)
    least, taken = 1 << 30, 0
    for r in sorted(short.groupBy(_size(F.col("n")).alias("size")).agg(F.count("*").alias("words")).collect(), reverse=True):
        taken += r.words
        if taken > HEAD:
            break
        least = r["size"]
    found = short.where(_size(F.col("n")) >= least).toArrow()
    head = sorted(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    ends = F.crc32(F.expr("substring(word, -2, 2)")) % OPEN
    sums = counts.groupBy(ends.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    tokens, words = np.zeros(OPEN), np.zeros(OPEN)
    for r in sums:
        tokens[r.c], words[r.c] = r.n, r.words
    whole = int(tokens.sum()), int(words.sum())
    for word, n in head[:OWN]:
        tokens[open_class(word)] -= n
        words[open_class(word)] -= 1
    return Vocabulary([w for w, _ in head], np.array([n for _, n in head], float), tokens, words, *whole, min(OWN, len(head)))


def trained(docs: DataFrame, v: Vocabulary) -> dict[str, np.ndarray]:
    """The network's parameters after ROUNDS rounds, which learn each of docs (doc_id, text) once."""
    s = v.shape()
    p = gru.initial(s, HIDDEN, v.counts[: v.own], v.open_tokens)
    replicas = max(1, -(-v.tokens // (ROUNDS * REPLICA)))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(ROUNDS))
    for n in range(ROUNDS):
        own = docs.where(part == n).select("text").coalesce(replicas)
        sums = stored(averaged(own.mapInArrow(_learner(p, s, v), "chunk int, tokens long, p binary")), "gru")
        found = {r.chunk: np.frombuffer(r.p) for r in sums.collect()}  # the parameters, whose number is fixed
        if found:
            flat, at = np.concatenate([found[c] for c in sorted(found)]), 0
            for k in p:
                p[k] = flat[at : at + p[k].size].reshape(p[k].shape).astype(np.float32)
                at += p[k].size
        removed(sums)
    return p


def _learner(p: dict[str, np.ndarray], s: gru.Shape, v: Vocabulary):
    def learn(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, own, total, held, now = Encoder(v), [], 0, 0, p
        for batch in batches:
            for text in texts(batch):
                own.append(encoder.type[encoder.ids(words_of(text))])
                held += len(own[-1])
                if held >= GROUP:
                    now, total, own, held = gru.learned(now, s, own), total + held, [], 0
        if own:
            now, total = gru.learned(now, s, own), total + held
        if total:
            flat = np.concatenate([x.reshape(-1) for x in now.values()]).astype(np.float64)
            parts = [flat[a : a + CHUNK].tobytes() for a in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([total] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "tokens", "p"])

    return learn


def averaged(replicas: DataFrame) -> DataFrame:
    """Rows (chunk, p): of each chunk (chunk, tokens, p) the mean by tokens, in running sums."""

    def mean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for c, n, p in zip(*(batch.column(x).to_pylist() for x in ("chunk", "tokens", "p")), strict=True):
                before = sums.get(c, (0, 0.0))
                sums[c] = before[0] + n, before[1] + n * np.frombuffer(p)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(x / n).tobytes() for n, x in sums.values()], pa.binary())], ["chunk", "p"])

    return replicas.repartition("chunk").mapInArrow(mean, "chunk int, p binary")


def by_network(docs: DataFrame, p: dict[str, np.ndarray], v: Vocabulary) -> DataFrame:
    """What a task knows of each of docs (doc_id, text, held_out): its row's number, tokens, known tokens and logs of counts of
    head words, the network's log10 probability without the counts of other words, and those words."""
    s = v.shape()
    names = ["row", "doc_id", "held_out", "n_tokens", "n_head", "head_log", "network", "others"]

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
        encoder, first, rows, types, held = Encoder(v), TaskContext.get().partitionId() << 40, [], [], 0

        def told() -> pa.RecordBatch:
            network = gru.scored(p, s, types) / np.log(10)
            whole = [(*r[:6], within + float(x), other) for (*r, within, other), x in zip(rows, network, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*whole, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for doc, held_out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts(batch), strict=True):
                words = words_of(text)
                ids = encoder.ids(words)
                outside = ids < 0
                rows.append((first, doc, held_out, len(ids), int(len(ids) - outside.sum()), float(encoder.log_count[ids].sum()), float(encoder.within[ids].sum()), list(compress(words, outside.tolist()))))
                types.append(encoder.type[ids])
                first, held = first + 1, held + len(ids)
                if held >= GROUP:
                    yield told()
                    rows, types, held = [], [], 0
        if rows:
            yield told()

    return docs.select("doc_id", "text", "held_out").mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, network double, others array<binary>")


def log_likelihoods(docs: DataFrame, fold: int = 7, held: int = 2) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, text), one a row of docs.

    Learns from documents whose crc32(doc_id as text) % fold is not held. Tokens are the words of the text with A-Z as a-z and
    one end; base_score is the text's log10 probability by counts of training tokens, add-one smoothed with one unknown word,
    score by the network.

    Defined results: a null text is empty, its only token the end; a null doc_id counts as an empty text in the fold; rows
    that repeat are counted, learned and scored each; a text of any length is scored whole, state carried on; without
    training texts nothing is known, and base_score is 0; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("held_out", ~is_training(F.col("doc_id"), fold, held))
    training = rows.where("NOT held_out")
    counts = stored(counted(training), "words")
    v = vocabulary(counts)
    known = stored(by_network(rows, trained(training, v), v), "scored")
    others = known.where(F.size("others") > 0).select("row", F.explode("others").alias("word")).join(counts, "word", "left")
    more = others.groupBy("row").agg(F.count("n").alias("n_more"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more"))
    all_ = known.drop("others").join(more, "row", "left").withColumn("more", F.coalesce("more", F.lit(0.0)))
    each = float(np.log10(v.tokens + v.distinct + 1))
    return all_.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_more", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("more") - F.col("n_tokens") * each).alias("base_score"), (F.col("network") + F.col("more")).alias("score"),
    )
