"""Best-fit packing of tokenised documents with Martello-Toth dominance reduction.

A packing instance is fixed by how many pieces there are of each length, so what reaches the driver is a histogram of at
most `capacity` counters, whatever the size of the corpus. There the reduction fixes sets that dominate every alternative,
best fit places the rest, both on counts; the result is a table of slots by length, of bounded size. Spark tokenises,
numbers the pieces within each length and joins them with the slots.
"""

from __future__ import annotations

import bisect
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._common import in_batches, stored, texts

#: Words of which a worker keeps the token ids; then it starts anew.
CACHE_WORDS = 350_000
#: Token ids of words by vocabulary, kept by a worker from task to task.
KNOWN: dict[str, dict[bytes, bytes]] = {}
#: ASCII punctuation that may end a word of letters; an apostrophe may begin a token with letters behind it.
TAIL = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
#: Parts in which the pieces of one length are numbered, so that a hot length is no single task.
RANK_PARTS = 256


class Words:
    """Token ids of words, for vocabularies that drop white space, ignore case and mark the end of words with </w>.

    Tokens never span white space there, so the ids of a text are those of its words. Words of ASCII letters go to the model
    as they are, in lower case, as nothing else is done to them before it; other words of letters are encoded many at a
    time, their ids told apart by the end marks; a word of letters and ASCII punctuation is put together from both.
    """

    def __init__(self, vocabulary: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(vocabulary)
        self.model = self.encoder.model
        ends = {i for token, i in self.encoder.get_vocab().items() if token.endswith("</w>")}
        self.ends = np.array([i in ends for i in range(self.encoder.get_vocab_size())])
        self.parts = regex.compile(r"(\p{L}+)([!-&(-/:-@\[-`{-~]*)")
        self.known = KNOWN.setdefault(vocabulary, {})

    def split(self, text: bytes) -> list[bytes]:
        # case is dropped by the vocabulary anyway, but not in the names of special tokens
        return (text if b"<|" in text else text.lower()).split()

    def alone(self, words: list[bytes]) -> None:
        for w, e in zip(words, self.encoder.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
            self.known[w] = np.array(e.ids, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        letters, others, joined = set(), set(), []
        for w in words.difference(self.known):
            core = w.rstrip(TAIL)
            if not core.isalpha():  # of ASCII letters only
                m = None if w.isascii() else self.parts.fullmatch(w.decode())
                if m is None:
                    others.add(w)
                    continue
                core = m[1].encode()
            letters.add(core)
            if len(core) < len(w):
                tail = w[len(core) :]
                joined.append((w, core, tail))
                others.add(tail)
        todo = []
        for w in letters.difference(self.known):
            if w.isascii():
                ids = [token.id for token in self.model.tokenize(w.lower().decode())]
                self.known[w] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                todo.append(w)
        for i in range(0, len(todo), 500):
            some = todo[i : i + 500]
            ids = np.array(self.encoder.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # letters that case folding takes apart
                self.alone(some)
                continue
            data = ids.tobytes()
            for w, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                self.known[w] = data[4 * a : 4 * b]
        self.alone([w for w in others if w not in self.known])
        for w, core, tail in joined:
            self.known[w] = self.known[core] + self.known[tail]

    def ids(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


def tokenised(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of each text's token ids and a final id 0, cut every capacity ids."""

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        from ledgerline.llm.op1_packing import Words

        words_of = Words(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            ids_of, todo = batch.column("doc_id").to_pylist(), texts(batch)
            for first in range(0, len(todo), 64):
                words = [words_of.split(t) for t in todo[first : first + 64]]
                words_of.learn(set().union(*words))
                for doc, ws in zip(ids_of[first : first + 64], words, strict=True):
                    ids = words_of.ids(ws) + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def reduced(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins (lengths, how many) of one to three pieces that dominance fixes for good; counts keeps the rest.

    In falling order of the largest piece x, with y the largest other that fits beside it: x alone if there is no y; with y
    if they fill the bin, or if no two others fit together beside x, or if no three do and no two are more than y. If no
    three others fit, x with y and the largest z that fits beside both, unless two others that fit are both larger than z.
    Any other bin with x can be exchanged for such a one piece by piece. Where none holds, x stays and the next one is
    looked at.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    have = sorted(x for x in counts if counts[x] > 0)

    def take(*bin_: int) -> None:
        times = Counter(bin_)
        n = min(counts[x] // m for x, m in times.items())
        fixed.append((bin_, n))
        for x, m in times.items():
            counts[x] -= n * m
            if not counts[x]:
                have.pop(bisect.bisect_left(have, x))

    def largest(room: int, *beside: int) -> int | None:
        """The largest piece of at most `room` that is left beside others."""
        at = bisect.bisect_right(have, room) - 1
        while at >= 0 and counts[have[at]] <= beside.count(have[at]):
            at -= 1
        return have[at] if at >= 0 else None

    def largest_two(room: int, x: int) -> tuple[int, int]:
        """Of pairs that fit in `room` beside x, the largest sum and the largest smaller piece."""
        total = smaller = 0
        low, high = 0, bisect.bisect_right(have, room) - 1
        while low <= high:
            y, z = have[low], have[high]
            if counts[z] == (z == x):
                high -= 1
            elif counts[y] == (y == x) or (low == high and counts[y] - (y == x) < 2):
                low += 1
            elif y + z > room:
                high -= 1
            else:
                total, smaller, low = max(total, y + z), max(smaller, y), low + 1
        return total, smaller

    i = len(have)
    while i > 0:
        x = have[i - 1]
        room = capacity - x
        others = [y for y in have[:4] for _ in range(min(3, counts[y] - (y == x)))][:3]
        y = largest(room, x)
        if y is None:
            take(x)
        elif y == room or sum(others[:2]) > room or len(others) < 2:
            take(x, y)
        elif len(others) < 3 or sum(others) > room:
            total, smaller = largest_two(room, x)
            z = largest(room - y, x, y)
            if total <= y:
                take(x, y)
            elif z is not None and smaller <= z:
                take(x, y, z)
            else:
                i -= 1
                continue
        else:
            i -= 1
            continue
        i = bisect.bisect_right(have, x)
    return fixed


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: equal bins are one group (lengths, how many) and are filled together."""
    groups: dict[tuple[int, ...], int] = {}
    rooms: dict[int, set[tuple[int, ...]]] = {}
    open_: list[int] = []  # rooms that have groups, sorted

    def put(bin_: tuple[int, ...], n: int) -> None:
        room = capacity - sum(bin_)
        groups[bin_] = groups.get(bin_, 0) + n
        if room not in rooms:
            rooms[room] = set()
            bisect.insort(open_, room)
        rooms[room].add(bin_)

    def drop(bin_: tuple[int, ...], n: int) -> None:
        groups[bin_] -= n
        if not groups[bin_]:
            del groups[bin_]
            room = capacity - sum(bin_)
            rooms[room].discard(bin_)
            if not rooms[room]:
                del rooms[room]
                open_.pop(bisect.bisect_left(open_, room))

    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n > 0:
            at = bisect.bisect_left(open_, x)
            if at < len(open_):
                room = open_[at]
                bin_ = min(rooms[room])
                # as long as the bin stays the tightest that fits, it takes more of the same
                more = max(1, min(room // x, n))
                m = min(groups[bin_], n // more)
                drop(bin_, m)
                put(bin_ + (x,) * more, m)
            else:
                more = max(1, min(capacity // x, n))
                m = n // more
                put((x,) * more, m)
            n -= m * more
    return list(groups.items())


def solved(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins (lengths, how many) that hold all pieces: those that dominance fixes, and best fit of the remainder."""
    left = Counter(counts)
    fixed = reduced(left, capacity)
    return fixed + best_fit(+left, capacity)


def slots(bins: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, base, each, offset): pieces first to last of a length go to sequences from base on, each per sequence, from offset."""
    taken: Counter = Counter()
    rows, base = [], 0
    for bin_, n in sorted(bins):
        offset = 0
        for x, each in sorted(Counter(bin_).items(), reverse=True):
            rows.append((x, taken[x], taken[x] + n * each - 1, base, each, offset))
            taken[x] += n * each
            offset += x * each
        base += n
    return rows


def ranked(pieces: DataFrame) -> DataFrame:
    """pieces with `rank` from 0 within their length: counts of parts are summed first, so no length is one group."""
    parts = pieces.withColumn("part", F.expr(f"pmod(xxhash64(doc_id, piece), {RANK_PARTS})"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = parts.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(sums, ["length", "part"]).withColumn("rank", F.col("ahead") + F.col("own")).drop("part", "ahead", "own")


def packed(docs: DataFrame, vocabulary: str, capacity: int = 2048) -> DataFrame:
    """One row per piece of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most capacity tokens and are filled from offset 0 without gaps; only documents longer than capacity
    are cut. Defined results: null or empty texts are one piece that holds the final id 0; rows that repeat a doc_id are
    packed each; a null doc_id stays null; an empty table gives an empty result; other columns are not read.
    """
    in_batches(docs.sparkSession)
    pieces = stored(tokenised(docs, vocabulary, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    table = pieces.sparkSession.createDataFrame(slots(solved(counts, capacity)), "length long, first long, last long, base long, each long, at long")
    placed = ranked(pieces).join(F.broadcast(table), "length").where("rank BETWEEN first AND last")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.expr("base + (rank - first) div each").alias("sequence_id"), F.expr("at + (rank - first) % each * length").alias("offset"))
