"""Exact k-means with heap-ordered bounds.

Every cluster keeps a heap of its vectors' gaps: lower bound on the distance to any other centroid minus upper bound on the
distance to the own one, offset by the drift that the cluster had accumulated when the gap was measured. A round adds to
each cluster's drift what its own and the farthest other centroid moved; gaps up to that drift have expired, and only those
vectors are popped and scanned against all centroids. Everybody else keeps its centroid without a look at the vector.

Arrow batches become blocks: one row with the ids, the vectors as packed integers, the clusters and the heaps. A round is
one narrow pass over the blocks, which also yields what moved vectors add to and take from the sums of each cluster; only
those sums meet in a shuffle, and k rows reach the driver. Blocks are written to the shared folder after each round.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm._common import removed, stored

#: Rows of a block at most.
BLOCK = 8192
#: Integer components are held within this bound, so that every squared distance fits a long (for 64 components).
LARGEST = 1 << 26
#: Up to this size, sums of 64 products are exact in doubles.
SMALL = 1 << 20
#: Bounds are widened by this share of what they are made of, far more than their rounding.
SLACK = 1e-9

_STATE = "ids array<long>, absent array<int>, v binary, width int, cluster binary, heaps array<struct<keys: array<double>, rows: array<int>>>, moved array<struct<cluster: int, n: long, sums: array<long>>>, scanned long"


def whole(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """Rows (vec_id, v): vectors of dim components, none null or non-finite, as floor(scale * x)."""
    rows = vectors.selectExpr("CAST(vec_id AS BIGINT) vec_id", "embedding v").where(F.size("v") == dim)
    rows = rows.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('inf'))")
    top = F.lit(float(LARGEST))
    held = F.transform("v", lambda x: F.floor(F.greatest(-top, F.least(top, x.cast("double") * scale))))
    return rows.select("vec_id", held.alias("v"))


def first_centroids(rows: DataFrame, k: int, prefix: str) -> list[list[int]]:
    """The k vectors with the smallest hashes of their ids (null ids last, equal ones by components), or all if there are fewer."""
    own = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    return [r.v for r in rows.orderBy(F.asc_nulls_last(own), "v").limit(k).collect()]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows of x to those of c, as int64."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= SMALL:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def nearest_two(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, ties to the smaller number, and a gap that is safely below lower minus upper bound."""
    own = d.argmin(axis=1)
    upper = np.sqrt(d[np.arange(len(d)), own].astype(np.float64))
    rest = d.copy()
    rest[np.arange(len(d)), own] = np.iinfo(np.int64).max
    lower = np.sqrt(rest.min(axis=1).astype(np.float64)) if d.shape[1] > 1 else np.full(len(d), np.inf)
    return own, np.where(np.isinf(lower), np.inf, lower - upper - SLACK * (1 + upper + np.where(np.isinf(lower), 0, lower)))


def packed_ints(x: np.ndarray) -> tuple[bytes, int]:
    """Integers in the fewest bytes each that hold all of them."""
    most = np.abs(x).max(initial=0)
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    return x.astype(f"<i{width}").tobytes(), width


def _moves(x: np.ndarray, old: np.ndarray, new: np.ndarray, k: int) -> list[dict]:
    """What vectors that left (old) or joined (new) clusters change: (cluster, n, sums); -1 is no cluster."""
    out = []
    for c in np.union1d(old, new).tolist():
        if c >= 0:
            came, went = x[new == c], x[old == c]
            out.append({"cluster": c, "n": len(came) - len(went), "sums": (came.sum(axis=0) - went.sum(axis=0)).tolist()})
    return out


def _state(ids: list, absent: list, v: bytes, width: int, cluster: np.ndarray, heaps: list, moved: list, scanned: int):
    import pyarrow as pa

    row = {"ids": ids, "absent": absent, "v": v, "width": width, "cluster": cluster.astype("<i4").tobytes(), "heaps": [{"keys": [g for g, _ in h], "rows": [i for _, i in h]} for h in heaps], "moved": moved, "scanned": scanned}
    kinds = [
        ("ids", pa.list_(pa.int64())), ("absent", pa.list_(pa.int32())), ("v", pa.binary()), ("width", pa.int32()), ("cluster", pa.binary()),
        ("heaps", pa.list_(pa.struct([("keys", pa.list_(pa.float64())), ("rows", pa.list_(pa.int32()))]))),
        ("moved", pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))), ("scanned", pa.int64()),
    ]
    return pa.RecordBatch.from_pylist([row], pa.schema(kinds))


def started(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Blocks of rows (vec_id, v): every vector is scanned once, and its cluster's heap gets its gap at drift zero."""
    k, dim = len(centroids), len(centroids[0])

    def start(batches: Iterator) -> Iterator:
        c = np.array(centroids, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column("vec_id").to_pylist()
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), dim)
                own, gap = nearest_two(squared(x, c))
                heaps = []
                for j in range(k):
                    at_j = np.flatnonzero(own == j)
                    heap = list(zip(gap[at_j].tolist(), at_j.tolist(), strict=True))
                    heapq.heapify(heap)
                    heaps.append(heap)
                absent = [i for i, v in enumerate(ids) if v is None]
                yield _state([v or 0 for v in ids], absent, *packed_ints(x), own, heaps, _moves(x, np.full(len(ids), -1), own, k), len(ids))

    return rows.select("vec_id", "v").mapInArrow(start, _STATE)


def _opened(row: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["v"], f"<i{row['width']}").reshape(-1, dim), np.frombuffer(row["cluster"], "<i4")


def rescanned(blocks: DataFrame, centroids: list[list[int]], drift: list[float]) -> DataFrame:
    """Blocks after a round: vectors whose gap the drift has reached are popped, scanned and pushed where they belong."""
    k, dim = len(centroids), len(centroids[0])

    def scan(batches: Iterator) -> Iterator:
        c = np.array(centroids, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                x, cluster = _opened(row, dim)
                heaps, out = [list(zip(h["keys"], h["rows"], strict=True)) for h in row["heaps"]], []
                for j, heap in enumerate(heaps):
                    while heap and heap[0][0] <= drift[j]:
                        out.append(heapq.heappop(heap)[1])
                at = np.array(out, np.int64)
                own, gap = nearest_two(squared(x[at].astype(np.int64), c)) if len(at) else (at, at)
                for i, j, g in zip(out, own.tolist(), gap.tolist(), strict=True):
                    heapq.heappush(heaps[j], (g + drift[j], i))
                now = cluster.copy()
                now[at] = own
                gone = at[now[at] != cluster[at]]
                yield _state(row["ids"], row["absent"], row["v"], row["width"], now, heaps, _moves(x[gone].astype(np.int64), cluster[gone], now[gone], k), len(out))

    return blocks.mapInArrow(scan, _STATE)


def assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Rows (vec_id, cluster, distance) of blocks, with the exact squared distance to the cluster's centroid."""
    dim = len(centroids[0])

    def tell(batches: Iterator) -> Iterator:
        import pyarrow as pa

        c = np.array(centroids, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                x, cluster = _opened(row, dim)
                d = ((x.astype(np.int64) - c[cluster]) ** 2).sum(axis=1)
                ids = np.array(row["ids"], np.int64)
                none = np.zeros(len(ids), bool)
                none[row["absent"]] = True
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=none), pa.array(cluster), pa.array(d)], ["vec_id", "cluster", "distance"])

    return blocks.select("ids", "absent", "v", "width", "cluster").mapInArrow(tell, "vec_id long, cluster int, distance long")


def _changes(blocks: DataFrame) -> list:
    """What a round's moves change, summed: rows (cluster, at, change), at a component or -1 for the number of vectors."""
    moved = blocks.select(F.inline("moved")).select("cluster", F.posexplode(F.concat(F.array("n"), "sums")).alias("at", "x"))
    return moved.groupBy("cluster", (F.col("at") - 1).alias("at")).agg(F.sum("x").alias("change")).collect()  # k x (dim + 1) rows at most


def _steps(old: list[list[int]], new: list[list[int]]) -> list[float]:
    """What each cluster's gaps may lose: the move of its centroid and the farthest move of another, rounded up."""
    moves = [(1 + SLACK) * sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) ** 0.5 for x, y in zip(old, new, strict=True)]
    return [m + max([0.0, *moves[:j], *moves[j + 1 :]]) for j, m in enumerate(moves)]


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, prefix: str = "2:") -> DataFrame:
    """k-means over integers floor(scale * x): rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    vectors (vec_id, embedding). Centroids start as the k vectors with the smallest sha256 of prefix and vec_id; in each
    round every vector goes to the nearest centroid (ties: the smaller number) and non-empty centroids become the floored
    mean of their vectors; then vectors are assigned once more. Exact: the bounds only save scans.

    Defined results: vectors that are null, of another length or hold null, NaN or infinite components are left out; a null
    vec_id takes part, as a first centroid after all others; rows that repeat are vectors of their own; with fewer vectors
    than k there are as many centroids; integers beyond 2^26 count as 2^26; an empty table gives an empty result; other
    columns are not read.
    """
    spark: SparkSession = vectors.sparkSession
    rows = whole(vectors, dim, scale)
    centroids = first_centroids(rows, k, prefix)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    k = len(centroids)
    counts, sums, drift = [0] * k, [[0] * dim for _ in range(k)], [0.0] * k
    blocks = stored(started(rows, centroids), "kmeans")
    for n in range(rounds):
        for r in _changes(blocks):
            if r.at < 0:
                counts[r.cluster] += r.change
            else:
                sums[r.cluster][r.at] += r.change
        moved_to = [[s // counts[j] for s in sums[j]] if counts[j] else centroids[j] for j in range(k)]
        drift = [a + b for a, b in zip(drift, _steps(centroids, moved_to), strict=True)]
        centroids, before = moved_to, blocks
        after = rescanned(blocks, centroids, drift)
        blocks = stored(after if n < rounds - 1 else assigned(after, centroids), "kmeans")
        removed(before)
    out = blocks if rounds else stored(assigned(blocks, centroids), "kmeans")
    hashed = spark.createDataFrame([(j, ",".join(map(str, c))) for j, c in enumerate(centroids)], "cluster int, _c string").select("cluster", F.sha2("_c", 256).alias("centroid_sha256"))
    inertia = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    per = hashed.join(inertia, "cluster").crossJoin(total)  # k rows and one
    return out.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
