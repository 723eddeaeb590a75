"""Removal of repeated 100-byte strings by suffix arrays.

1. Every window of `length` bytes is routed by its least hash of GRAM-byte strings (its minimizer): equal windows have
   equal minimizers. Runs of windows with one minimizer are counted by it; single ones repeat nowhere and go no further.
2. The runs that are left, each with the bytes its windows cover, are dealt to shards by minimizer. A shard is a block of
   whole minimizer groups; its suffix array is built by Larsson-Sadakane refinement, common prefixes by Kasai, and of
   each class of suffixes with `length` bytes in common all but the earliest window are repeats. A minimizer with more
   bytes than a block is cut into several shards in text order; the later ones are merged with the earlier ones by
   binary search in their sorted suffixes.
3. Repeated windows return to their documents and the bytes they cover are removed.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._common import in_batches, texts

GRAM = 32
#: Bytes of text hashed at a time, and bytes of a shard's suffix array.
CHUNK, SHARD = 1 << 17, 1 << 19
#: Low bits of a packed run that hold its number of windows, at most CHUNK.
RUN_BITS = 18
#: Stands for a null doc_id; before all others.
NO_ID = -(1 << 63)


def least_hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of length bytes of data, the least hash of the GRAM-byte strings in it, and whether the first string has it."""
    h, have = data.astype(np.uint64) + np.uint64(1), 1
    while have < GRAM:  # strings of twice the length, from two halves
        h = h[:-have] * np.uint64(0xD6E8FEB86659FD93 + 2 * have) + h[have:]
        have *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    grams, w, have = h, length - GRAM + 1, 1
    while 2 * have <= w:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    least = np.minimum(h[: len(h) - (w - have)], h[w - have :])
    return least, grams[: len(least)] == least


def runs(docs: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of consecutive windows with one least hash: arrays (index of the document, first window, windows, hash, inner).

    inner: whether windows of the run may equal one another. If two do, the leftmost least string of the first one starts
    ahead of the second one, and the run goes on behind the window that starts with that string.
    Documents are joined up to CHUNK bytes; a longer one is cut into parts that overlap by length - 1 bytes.
    """

    def parts() -> Iterator[tuple[int, int, bytes]]:
        for i, d in enumerate(docs):
            for at in range(0, len(d) - length + 1, CHUNK):
                yield i, at, d[at : at + CHUNK + length - 1]

    def of(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(x[2]) for x in held])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        least, starts_with = least_hashes(np.frombuffer(b"".join(x[2] for x in held), np.uint8), length)
        cut = np.concatenate(([True], least[1:] != least[:-1], [True]))
        ends = starts[1:] - length + 1  # first window that is not wholly in the document
        cut[starts[:-1]] = True
        cut[ends] = True
        edges = np.flatnonzero(cut)
        first, n = edges[:-1], np.diff(edges)
        own = np.searchsorted(starts, first, "right") - 1
        inner = np.zeros(len(first), bool)
        inner[np.searchsorted(first, np.flatnonzero(starts_with & ~cut[1:]), "right") - 1] = True
        good = first < ends[own]
        first, n, own, inner = first[good], n[good], own[good], inner[good]
        doc, at = np.array([x[0] for x in held]), np.array([x[1] for x in held])
        return doc[own], first - starts[own] + at[own], n, least[first].view(np.int64), inner

    held, size = [], 0
    for part in parts():
        held.append(part)
        size += len(part[2])
        if size >= CHUNK:
            yield of(held)
            held, size = [], 0
    if held:
        yield of(held)


def gathered(docs: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    found = list(runs(docs, length))
    return tuple(np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64 if i < 4 else bool) for i in range(5))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of the suffixes of data (uint8) in their order, by Larsson and Sadakane's refinement.

    Starts from keys of 8 bytes; then sorts by pairs of ranks h apart, for h = 8, 16, ..., only the groups that are not
    yet single, until all are.
    """
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | wide[i : i + n]
    order = np.argsort(key, kind="stable")
    ranks = np.empty(n, np.int64)
    head = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    ranks[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while True:
        single = head & np.concatenate((head[1:], [True]))
        at = np.flatnonzero(~single)  # places of the groups to refine
        if not len(at):
            break
        group = order[at]
        after = np.zeros(len(group), np.int64)
        inside = group + h < n
        after[inside] = ranks[group[inside] + h] + 1
        pair = (ranks[group].astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        by = np.argsort(pair, kind="stable")
        order[at], pair = group[by], pair[by]
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        head[at] = new
        ranks[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        h *= 2
    return order


def kasai(data: np.ndarray, order: np.ndarray, most: int, lanes: int = 2048) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it in order, at most `most`.

    Kasai's walk in text order, where the common prefix shrinks by one a step at most, taken in many places at once: the
    text is cut into lanes that advance together.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    wide = np.concatenate([data.astype(np.int16), np.full(most + 1, -1, np.int16)])
    lanes = max(1, min(lanes, n // 64))
    ends = np.linspace(0, n, lanes + 1).astype(np.int64)
    i, end = ends[:-1].copy(), ends[1:]
    same = np.zeros(lanes, np.int64)
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(i < end)
    while len(live):
        p, s = i[live], same[live]
        q = before[p]
        grows = (q >= 0) & (s < most) & (p + s < n) & (wide[p + s] == wide[np.maximum(q, 0) + s]) & (np.maximum(q, 0) + s < n)
        same[live[grows]] += 1
        rest = live[~grows]
        done = before[i[rest]] >= 0
        out[i[rest]] = np.where(done, same[rest], 0)
        same[rest] = np.where(done, np.maximum(same[rest] - 1, 0), 0)
        i[rest] += 1
        if (i[rest] >= end[rest]).any():
            live = live[i[live] < end[live]]
    common = np.zeros(n, np.int64)
    common[:] = out[order]
    return common


def repeats(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pieces in text order: arrays (piece, window in it) of all windows, and whether an equal one starts earlier."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    order = suffix_array(data)
    kind = np.cumsum(kasai(data, order, length) < length)
    whole = np.zeros(len(data), bool)  # positions whose window ends in their piece
    size = np.diff(starts)
    own = np.repeat(np.arange(len(pieces)), size)
    whole = np.arange(len(data)) - starts[own] <= size[own] - length
    sel = whole[order]
    at, kind = order[sel], kind[sel]
    by = np.lexsort((at, kind))
    at, kind = at[by], kind[by]
    first = np.concatenate(([True], kind[1:] != kind[:-1])) if len(at) else np.empty(0, bool)
    again = np.zeros(len(data), bool)
    again[at[~first]] = True
    at = np.flatnonzero(whole)
    return own[at], at - starts[own[at]], again[at]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id as `id` (nulls as the least number), `th` that tells rows of one doc_id apart, and the text."""
    return docs.selectExpr(f"coalesce(CAST(doc_id AS BIGINT), {NO_ID}) id", "coalesce(text, '') text").selectExpr("id", "hash(text) th", "text")


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """Runs of windows by least hash, from rows (id, th, text). known: repeated in its batch; of those, one stands for all in the count."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            doc, first, _, least, inner = gathered(texts(batch), length)
            ids, th = (batch.column(c).to_numpy() for c in ("id", "th"))
            _, at, inverse, n = np.unique(least, return_index=True, return_inverse=True, return_counts=True)
            known = (n[inverse] > 1) | inner
            stands = np.zeros(len(least), bool)
            stands[at] = True
            salt = np.where(stands, 0, 1 + (doc & 0xFF))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (least, salt, ids[doc], th[doc], first, known)], ["least", "salt", "id", "th", "first", "known"])

    return docs.select("id", "th", "text").mapInArrow(scan, "least long, salt long, id long, th int, first long, known boolean")


def _routed(docs: DataFrame, length: int) -> DataFrame:
    """From rows (id, th, text, firsts): the listed runs with the bytes of their windows; within a batch, equal bytes once.

    Runs whose bytes an earlier run of the batch has are repeats as a whole: they carry no bytes, and a salt. The same run
    of a row that repeats doc_id and text is no repeat and goes no further.
    """

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            docs_, ids, th, wanted = texts(batch), batch.column("id").to_numpy(), batch.column("th").to_numpy(), batch.column("firsts")
            doc, first, n, least, _ = gathered(docs_, length)
            flat, owner = wanted.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(docs_)), np.diff(wanted.offsets.to_numpy()))
            span = max((len(d) for d in docs_), default=0) + 1
            sel = np.isin(doc * span + first, owner * span + flat)
            doc, first, n, least = doc[sel], first[sel], n[sel], least[sel]
            by = np.lexsort((first, th[doc], ids[doc]))
            doc, first, n, least = doc[by], first[by], n[by], least[by]
            seen: dict[bytes, tuple[int, int, int]] = {}
            parts: list[bytes | None] = []
            own = np.ones(len(doc), bool)
            for k, (d, f, m) in enumerate(zip(doc.tolist(), first.tolist(), n.tolist(), strict=True)):
                part, run = docs_[d][f : f + m + length - 1], (ids[d], th[d], f)
                if part not in seen:
                    seen[part] = run
                    parts.append(part)
                elif seen[part] == run:  # the same run, of a row that repeats doc_id and text
                    own[k] = False
                else:
                    parts.append(None)
            doc, first, n, least = doc[own], first[own], n[own], least[own]
            salt = np.array([0 if p is not None else 1 + (k & 0xFF) for k, p in enumerate(parts)], np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (least, salt, ids[doc], th[doc], first, n)), pa.array(parts, pa.binary())], ["least", "salt", "id", "th", "first", "n", "part"])

    return docs.select("id", "th", "text", "firsts").mapInArrow(route, "least long, salt long, id long, th int, first long, n long, part binary")


def _shards(rows: DataFrame, length: int) -> DataFrame:
    """From runs sorted by (least, id, th, first): rows (id, th, first, n) of windows that an earlier equal window has."""

    def solve(held: list[tuple], earlier: list[bytes], carries: bool) -> tuple[list[tuple], list[bytes]]:
        """held: (least, id, th, first, n, part) in order. earlier: sorted windows of the first minimizer from shards before this one."""
        out: list[tuple] = []
        place: dict[bytes, int] = {}
        kept: list[tuple] = []
        for x in held:
            if x[5] is None:
                out.append(x[1:5])
            elif x[5] in place:  # the same bytes as an earlier run: all its windows are repeats, unless it is the same run
                if kept[place[x[5]]][1:4] != x[1:4]:
                    out.append(x[1:5])
            else:
                place[x[5]] = len(kept)
                kept.append(x)
        if not kept:
            return out, earlier
        own, at, again = repeats([x[5] for x in kept], length)
        last = kept[-1][0]
        fresh: list[bytes] = []
        if earlier or carries:
            hot = held[0][0] if earlier else None
            for k in np.flatnonzero(~again).tolist():
                x = kept[own[k]]
                if x[0] != hot and not (carries and x[0] == last):
                    continue
                window = x[5][at[k] : at[k] + length]
                if x[0] == hot:
                    j = bisect.bisect_left(earlier, window)
                    if j < len(earlier) and earlier[j] == window:
                        again[k] = True
                        continue
                if carries and x[0] == last:
                    fresh.append(window)
            earlier = sorted((earlier if hot == last else []) + fresh) if carries else []
        edge = np.concatenate(([True], (own[1:] != own[:-1]) | (again[1:] != again[:-1]))) if len(own) else np.empty(0, bool)
        begin = np.flatnonzero(edge)
        for b, m in zip(begin.tolist(), np.diff(np.append(begin, len(own))).tolist(), strict=True):
            if again[b]:
                x = kept[own[b]]
                out.append((x[1], x[2], x[3] + int(at[b]), m))
        return out, earlier

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[tuple] = []
        size, earlier = 0, []

        def told(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "th", "first", "n"])

        for batch in batches:
            for x in zip(*(batch.column(c).to_pylist() for c in ("least", "id", "th", "first", "n", "part")), strict=True):
                # rows that repeat doc_id and text have the same runs; these stay in one shard
                if size >= SHARD and (x[0] != held[-1][0] or size >= 2 * SHARD and x[1:4] != held[-1][1:4]):
                    out, earlier = solve(held, earlier, x[0] == held[-1][0])
                    yield told(out)
                    held, size = [], 0
                held.append(x)
                size += len(x[5] or b"")
        if held:
            yield told(solve(held, earlier, False)[0])

    return rows.select("least", "id", "th", "first", "n", "part").mapInArrow(work, "id long, th int, first long, n long")


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """From rows (id, text, gone): what is left of each text."""

    def cut(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for text, gone in zip(texts(batch), batch.column("gone").to_pylist(), strict=True):
                spans: list[list[int]] = []
                for x in sorted((g >> RUN_BITS, g & ((1 << RUN_BITS) - 1)) for g in gone or ()):
                    end = x[0] + x[1] - 1 + length
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([x[0], end])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                left = b"".join(kept)
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(left))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            ids = pa.array([None if i == NO_ID else i for i in batch.column("id").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], ["doc_id", *out])

    return docs.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    Texts are UTF-8 bytes. A byte goes if a string of length bytes that covers it also starts earlier: in a smaller
    doc_id, or further ahead in the same document. length is GRAM or more. Defined results: null counts as empty; texts
    shorter than length stay whole; rows that repeat doc_id and text are one document and get the same result each;
    rows of one doc_id and different texts are ordered by a hash of the text; null doc_ids come before all others; an
    empty table gives an empty result; other columns are not read.
    """
    in_batches(docs.sparkSession, 10_000)  # equal contexts of a batch travel once
    rows = _keyed(docs)  # both joins below read the same exchange of these
    count = F.count("*").over(Window.partitionBy("least", "salt"))
    found = _anchors(rows, length).withColumn("known", F.col("known") | (count > 1)).where("known")
    wanted = found.groupBy("id", "th").agg(F.collect_list("first").alias("firsts"))
    routed = _routed(rows.join(wanted, ["id", "th"]), length)
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    gone = _shards(routed.repartition(n, "least", "salt").sortWithinPartitions("least", "id", "th", "first"), length)
    spans = gone.groupBy("id", "th").agg(F.collect_set(F.shiftleft("first", RUN_BITS) + F.col("n")).alias("gone"))
    return _cut(rows.join(spans, ["id", "th"], "left").select("id", "text", "gone"), length)
