"""Near-duplicate documents by HyperMinHash banding, with exact links.

A document's shingle set is sketched into REGISTERS buckets; a register keeps the leading-zero count and MANTISSA bits of
the bucket's smallest hash (16 bits), empty ones borrow from full ones in a random order of their own. Bands of ROWS registers put documents into
buckets. Each bucket is compared with one hub, its document that shares most buckets; links are confirmed on full sets.

Pairs inside a bucket are not emitted. For a member m of the bucket of hub o let M = o - m and X = m - o. If f is not
linked with o, then f and v are linked only if their differences (M and X) share more than (5 |M_v| + 4 |X_v|) / 9 elements,
that is over half of v's. The differences of edited copies are mostly their own, so a join on the differences that
more than one member has finds every such pair and few others (see met_by_differences). Pairs so found are first
estimated from the registers (collisions subtracted), those that miss the threshold by more than a bound of 1e-12 error go, the others are verified on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._common import WordHashes, components, in_batches, shingles, small_or_shuffled, stored, texts

BANDS, ROWS, MANTISSA = 40, 5, 10
REGISTERS = BANDS * ROWS
#: What empty registers borrow from: row i has, for each, the i-th register that it asks.
PROBES = np.random.default_rng(20).integers(0, REGISTERS, (400, REGISTERS))


def registers(s: np.ndarray) -> np.ndarray:
    """REGISTERS 16-bit registers of a sorted non-empty set of 64-bit hashes."""
    bins = ((s >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    # the place within the bucket, as 32 high and 24 low bits of it
    rest = (s[first] * np.uint64(REGISTERS)) >> np.uint64(11)
    m, e = np.frexp(rest.astype(np.float64) + 1.0)
    value = ((54 - e) << MANTISSA | ((m - 0.5) * (2 << MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)).astype(np.uint16)
    out, full = np.zeros(REGISTERS, np.uint16), np.zeros(REGISTERS, bool)
    at = bins[first].astype(np.int64)
    out[at], full[at] = value, True
    empty = np.flatnonzero(~full)
    for probe in PROBES:  # each empty one asks others in an order of its own
        if not len(empty):
            return out
        asked = probe[empty]
        got = full[asked]
        out[empty[got]] = out[asked[got]]
        empty = empty[~got]
    out[empty] = value[np.searchsorted(at, empty) % len(at)]
    return out


def collisions(n: int, m: int) -> float:
    """Chance that two buckets of sets with n and m elements hold different smallest hashes but equal registers."""
    a, b, total = max(n / REGISTERS, 1.0), max(m / REGISTERS, 1.0), 0.0
    for z in range(1, 40):
        hi, lo = 2.0 ** (1 - z), 2.0**-z
        total += ((1 - lo) ** a - (1 - hi) ** a) * ((1 - lo) ** b - (1 - hi) ** b)
    return total / (1 << MANTISSA)


def estimated(x: np.ndarray, y: np.ndarray, n: int, m: int) -> tuple[float, float]:
    """Collision-corrected estimate of the Jaccard similarity, and a bound that the true one exceeds once in 1e12."""
    c = collisions(n, m)
    j = (float(np.mean(x == y)) - c) / (1 - c)
    seen = min(REGISTERS, n, m) / 2  # independent buckets, at least
    return j, j + math.sqrt(math.log(1e12) / (2 * seen))


def signed(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, n_shingles, digest of the set, registers); digest and registers are null for texts without words."""

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        hashes = WordHashes()
        for batch in batches:
            n, digest, regs = [], [], []
            for text in texts(batch):
                s = shingles(text, k, hashes)
                n.append(len(s))
                digest.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "digest", "regs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, "doc_id long, n_shingles long, digest binary, regs binary")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Rows (id, regs, elems) with the whole shingle set of each document in ids."""

    def collect(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, k, hashes) for t in texts(batch)]
            keep = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep, pa.int64())), pa.array([registers(sets[i]).tobytes() for i in keep], pa.binary()), pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["id", "regs", "elems"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return rows.join(small_or_shuffled(ids, 16), "id", "left_semi").mapInArrow(collect, "id long, regs binary, elems binary")


def linked(inter: int, n: int, m: int, percent: int) -> bool:
    return 100 * inter >= percent * (n + m - inter)


def against_hub(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each edge (hub, id) on full sets: is_link, the sizes o of the hub, m of what is missing and x of what is extra, and both.

    gone is whole for members that are not linked; of linked ones it is what a pair must share one of, if not of extra.
    """

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: dict[str, list] = {"is_link": [], "o": [], "m": [], "x": [], "lead": [], "extra": [], "gone": []}
            hubs, ids = batch.column("hub_elems").to_pylist(), batch.column("elems").to_pylist()
            for a, b in zip(hubs, ids, strict=True):
                o, m = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
                extra, gone = np.setdiff1d(m, o, assume_unique=True), np.setdiff1d(o, m, assume_unique=True)
                link = linked(len(m) - len(extra), len(o), len(m), percent)
                # linked: (100 + p) I >= p (n + m), p in percent; with f unlinked to the hub it follows (100 + p) shared >= 100 |M| + p |X| + 1
                need = -(-(100 * len(gone) + percent * len(extra) + 1) // (100 + percent))
                lead = max(0, len(gone) - need + 1)
                out["is_link"].append(link)
                out["o"].append(len(o))
                out["m"].append(len(gone))
                out["x"].append(len(extra))
                out["lead"].append(lead)
                out["extra"].append(extra)
                out["gone"].append(gone[:lead] if link else gone)
            kinds = (pa.bool_(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2)
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], ["hub", "id", *out])

    own = edges.join(sets.select("id", "elems"), "id")
    both = own.join(sets.select(F.col("id").alias("hub"), F.col("elems").alias("hub_elems")), "hub")
    return both.select("hub", "id", "hub_elems", "elems").mapInArrow(compare, "hub long, id long, is_link boolean, o long, m long, x long, lead long, extra array<long>, gone array<long>")


def met_by_differences(star: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one hub, not both linked with it, that may be linked.

    With M and X of both members, (100 + p) shared >= 100 (|M_f| + |M_v|) + p (|X_f| + |X_v|) - (100 - p) |o|, and what
    they share is at most the smaller M and the smaller number of extra elements that any other member has too. A pair
    shares an extra element, or more than `lead` leaves out of M in the order of elements.
    """
    sizes = ["hub", "id", "is_link", "o", "m", "x"]
    extra = star.select("hub", "id", F.explode("extra").alias("e"))
    twice = extra.groupBy("hub", "e").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    common = stored(extra.join(twice, ["hub", "e"]), "common-differences")
    star = star.join(common.groupBy("hub", "id").agg(F.count("*").alias("c")), ["hub", "id"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sized = common.join(star.select(*sizes, "c"), ["hub", "id"])

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("hub", "e", *[F.col(c).alias(f"{name}_{c}") for c in ("id", "is_link", "o", "m", "x", "c")])

    room = f"{100 + percent} * (least(f_m, v_m) + least(f_c, v_c)) >= 100 * (f_m + v_m) + {percent} * (f_x + v_x) - {100 - percent} * f_o"
    meet = f"f_id <> v_id AND NOT f_is_link AND {room}"
    by_extra = side(sized.where("NOT is_link"), "f").join(side(sized, "v"), ["hub", "e"]).where(f"{meet} AND (v_is_link OR v_id < f_id)")
    lead = star.where("lead > 0").withColumn("e", F.explode(F.expr("slice(gone, 1, CAST(lead AS INT))")))
    all_gone = star.where("NOT is_link").withColumn("e", F.explode("gone"))
    by_gone = side(all_gone, "f").join(side(lead, "v"), ["hub", "e"]).where(meet)
    ends = [F.least("f_id", "v_id").alias("a"), F.greatest("f_id", "v_id").alias("b")]
    return by_extra.select(*ends).union(by_gone.select(*ends)).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that are linked: estimated from registers first, then verified on full sets."""

    def estimate(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("ra", "rb", "na", "nb")]
            keep = [estimated(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), n, m)[1] >= percent / 100 for x, y, n, m in zip(*cols, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ea").to_pylist(), batch.column("eb").to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(linked(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(x: str) -> DataFrame:
        return sets.select(F.col("id").alias(x), F.col("regs").alias(f"r{x}"), F.expr("octet_length(elems) div 8").alias(f"n{x}"))

    likely = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(estimate, "a long, b long")
    likely = stored(likely, "likely")
    elems = [sets.select(F.col("id").alias(x), F.col("elems").alias(f"e{x}")) for x in "ab"]
    return likely.join(elems[0], "a").join(elems[1], "b").select("a", "b", "ea", "eb").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents whose sets of distinct k-word shingles have a Jaccard similarity of percent / 100 or more are linked;
    component_id is the smallest doc_id reachable over links. Rows of equal sets form one class before any comparison.
    Defined results: null or wordless texts have an empty set, are linked with nothing and are their own component; rows
    with a null doc_id have a null component and are kept; rows that repeat a doc_id are one document with the links of
    all of them; an empty table gives an empty result; columns other than doc_id and text are not read.
    A link of exactly the threshold is missed with a chance of about 1e-7 (BANDS of ROWS registers).
    """
    in_batches(docs.sparkSession)
    sig = stored(signed(docs, k), "signatures")
    known = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    # one or more shared of two different sets needs four elements at 80 percent: one missing of n leaves (n - 1) / n
    least = max(1, math.ceil(percent / (100 - percent))) if percent < 100 else 1 << 62
    reps = known.where(F.col("n_shingles") >= least).join(classes, (known.digest == classes.digest) & (F.col("doc_id") == F.col("rep")), "left_semi")
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)])
    bands = reps.select(F.col("doc_id").alias("id"), F.explode(keys).alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(bands.join(shared, "band"), "buckets")
    # the text that others were made from shares most buckets: it is the hub, and its copies' differences are their own
    degree = met.groupBy("id").agg(F.sum("n").alias("degree"))
    hubs = met.join(degree, "id").groupBy("band").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("hub"))
    edges = stored(met.join(hubs, "band").where("id <> hub").select("hub", "id").distinct(), "candidates")
    ids = stored(edges.select("id").union(edges.select("hub")).distinct(), "ids")
    sets = stored(full_sets(docs, ids, k), "sets")
    star = stored(against_hub(edges, sets, percent), "stars")
    pairs = met_by_differences(star, percent)
    links = star.where("is_link").select(F.col("hub").alias("a"), F.col("id").alias("b")).union(confirmed(pairs, sets, percent))
    groups = components(links).withColumnsRenamed({"node": "rep", "component": "linked_id"})
    of_class = classes.join(groups, "rep", "left").select("digest", F.coalesce("linked_id", "rep").alias("component_id"))
    out = sig.join(of_class, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.expr("doc_id <=> component_id"))
