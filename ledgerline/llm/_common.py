"""Shared helpers of the text operators: stored cuts of lineage, checked broadcasts, word hashes and components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one side of a join that may be broadcast; larger sides are shuffled.
BROADCAST_BYTES = 8 << 20
#: Entries that a worker's cache of word hashes holds before it starts anew.
CACHE_WORDS = 150_000
#: Spark's setting by which an execution's shuffle files go with its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir() + "/ledgerline-shared"
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and lost executors cost no recomputation.

    What df shuffled is of no use once it is written, and is deleted then rather than when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a stored frame that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def small_or_shuffled(df: DataFrame, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows fit in BROADCAST_BYTES; else as it is, so that the join shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def in_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts go to Python workers in Arrow batches of so many rows; the session's setting, as plans read it when they are made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def set_aside(docs: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns of these names (in any case) under new ones, and the way back for withColumnsRenamed."""
    taken, back = {c.lower() for c in docs.columns} | names, {}
    for c in docs.columns:
        if c.lower() in names:
            new = next(n for i in range(len(taken) + 1) if (n := f"own_{i}_{c}").lower() not in taken)
            taken.add(new.lower())
            back[new] = c
    return docs.withColumnsRenamed({c: new for new, c in back.items()}), back


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component the smallest node reachable.

    Alternating large-star and small-star rounds. Each round joins every edge with the smallest neighbour of one end,
    which is aggregated on the map side first, so a hub with very many edges is a skewed join (split by AQE), never a
    group collected in one task. Self loops and null ends are ignored; an empty input gives an empty result.
    """
    key = "CAST(sum(CAST(xxhash64(a, b) AS DECIMAL(38, 0))) AS STRING)"
    e = stored(edges.select("a", "b").where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "edges")
    before = None
    while True:
        now = e.selectExpr("count(*) n", f"{key} k").first()
        if now.n == 0 or now == before:
            break
        before = now
        both = e.union(e.selectExpr("b a", "a b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("b a", "m b").where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.selectExpr("b a", "m b").where("a <> b").union(small.selectExpr("a", "m b"))
        e, old = stored(small.distinct(), "edges"), e
        removed(old)
    # a fixed point is a set of stars: each node but the smallest points to the smallest
    return e.selectExpr("a node", "b component").union(e.selectExpr("b node", "b component").distinct())


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; bounded, so that a worker's memory does not grow with the vocabulary."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text; A-Z count as a-z, words end at ASCII white space.

    A text of fewer than k words has one shingle, the whole sequence; without words the result is empty.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(k, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return np.unique(mix(s))


def texts(batch, name: str = "text") -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes, nulls as empty."""
    import pyarrow as pa

    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]
