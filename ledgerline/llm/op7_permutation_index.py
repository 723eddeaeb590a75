"""Nearest neighbours by a permutation index: vectors as ordered nearest pivots, posted in pivot inverted files.

A vector is represented by its NEAR nearest pivots in order. The index is dealt in blocks of BLOCK rows, each with an
inverted file of its own: for every pivot, the rows that have it and its place in their order. A query goes through the
postings of its QUERY_NEAR nearest pivots in every block, which ranks the block's rows by the footrule distance of the two
orders; the SHARE nearest of them are ranked again by cosine on the vectors. Queries are dealt in blocks too, so that
index and queries meet block by block, and every block returns its few best.
Vectors with equal components are one class in the index, with its smallest members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._common import stored

#: Pivots: the first classes by hash, a bounded sample that reaches every task.
PIVOTS, NEAR, QUERY_NEAR = 256, 128, 64
BLOCK, QUERY_BLOCK = 8192, 512
#: Of a block's rows, so many are ranked again, or all if there are fewer than LEAST.
SHARE, LEAST = 0.03, 250
#: Groups of blocks of the index, to each of which all queries are copied, and blocks of a group at most.
GROUPS, GROUP = 64, 4


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, v) that take part: no null, zero, non-finite or null-holding vector, no null vec_id; of the most frequent dimension."""
    rows = vectors.selectExpr("CAST(vec_id AS BIGINT) vec_id", "embedding v").where("vec_id IS NOT NULL AND size(v) > 0")
    rows = rows.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('inf')) AND exists(v, x -> x <> 0)")
    dim = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(dim.select("d")), F.size("v") == F.col("d"), "left_semi")


def scaled(x: np.ndarray) -> np.ndarray:
    """The rows of x times powers of two that bring their largest components near one: cosines stay as they are, and no norm overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def orders(x: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """The near nearest pivots of each row of x, nearest first."""
    far = -(x / np.linalg.norm(x, axis=1, keepdims=True)) @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :near].astype(np.int16)


def blocks(rows: DataFrame, size: int, pivots: np.ndarray, near: int, name: str) -> tuple[DataFrame, int]:
    """One row (block, ids, firsts, v, orders) for about `size` of rows (id, first, v), dealt by hash; and how many blocks."""
    n = max(1, -(-rows.count() // size))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        x = scaled(np.stack(part["v"].to_numpy()).astype(np.float64))
        return pd.DataFrame({"block": part["block"].iloc[:1], "ids": [part["id"].to_numpy()], "firsts": [part["first"].to_numpy()], "v": [x.tobytes()], "orders": [orders(x, pivots, near).tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return stored(dealt.groupBy("block").applyInPandas(pack, "block int, ids array<long>, firsts array<long>, v binary, orders binary"), name), n


def searched(met: DataFrame, near: int, asked: int, k: int) -> DataFrame:
    """Of each pair of an index block and a query block (ids, firsts, v, orders, qids, qv, qorders): rows (q, cls, first, score), k a query.

    Of equal scores and equal footrules, those with the smallest `firsts` are taken.
    """

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found: list[tuple] = []
            for ids, firsts, v, order, qids, qv, qorder in zip(*(batch.column(c).to_pylist() for c in ("ids", "firsts", "v", "orders", "qids", "qv", "qorders")), strict=True):
                x, q = np.frombuffer(v).reshape(len(ids), -1), np.frombuffer(qv).reshape(len(qids), -1)
                # for every pivot, its place with every row, near where it isn't among the row's nearest
                places = np.full((PIVOTS, len(ids)), near, np.uint8)
                places[np.frombuffer(order, np.int16).reshape(len(ids), -1).T, np.arange(len(ids))] = np.arange(near, dtype=np.uint8)[:, None]
                norms, ids, firsts = np.sqrt(np.einsum("ij,ij->i", x, x)), np.array(ids), np.array(firsts)
                late = np.argsort(np.argsort(firsts, kind="stable"), kind="stable")
                best = min(len(ids), max(LEAST, int(np.ceil(SHARE * len(ids)))))
                place = np.arange(asked, dtype=np.uint8)[:, None]
                for a, y, its in zip(qids, q, np.frombuffer(qorder, np.int16).reshape(len(qids), -1), strict=True):
                    # the footrule of two orders falls by what shared pivots gain: near - max(place, place) each
                    gain = near * asked - np.maximum(places[its[:asked]], place).sum(axis=0, dtype=np.uint16).astype(np.int64)
                    top = np.argpartition(late - gain * len(ids), best - 1)[:best]
                    score = np.einsum("ij,j->i", x[top], y) / (norms[top] * np.sqrt(y @ y))
                    first = np.lexsort((firsts[top], -score))[:k]
                    found += zip([a] * len(first), ids[top][first].tolist(), firsts[top][first].tolist(), score[first].tolist(), strict=True)
            cols = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["q", "cls", "first", "score"])

    return met.select("ids", "firsts", "v", "orders", "qids", "qv", "qorders").mapInArrow(search, "q long, cls long, first long, score double")


def together(queries: DataFrame, index: DataFrame, n: int) -> DataFrame:
    """Every block of queries with each of the n blocks of index (see blocks): rows (ids, firsts, v, orders, qids, qv, qorders).

    Blocks of queries are copied once for each group of blocks of the index, of which there are up to GROUPS, or more if a
    group had over GROUP blocks, and are dealt to them by a shuffle whatever the planner takes them for: it doesn't see that
    the copies are many times the queries, and would send them through the driver.
    """
    groups = max(min(n, GROUPS), -(-n // GROUP))
    dealt = index.withColumn("group", F.col("block") % groups)
    copies = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.col("ids").alias("qids"), F.col("v").alias("qv"), F.col("orders").alias("qorders"))
    # a merge keeps one group of the index in memory, and goes through the queries
    return copies.hint("merge").join(dealt, "group")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k nearest found by cosine for each row of vectors (vec_id, embedding) whose vec_id is divisible by every.

    Rows (query_id, rank from 1, vec_id, score); ties go to the smaller vec_id; candidates are all rows but those of the
    query's own vec_id. With LEAST classes a block or fewer the search is exact. Defined results: rows that take no part
    (see usable) are neither queries nor found; a query with fewer candidates than k gets them all; rows that repeat vec_id
    and vector count once; an empty table gives an empty result; other columns are not read.
    """
    rows = usable(vectors)
    spark = vectors.sparkSession
    # a class keeps its k + 1 smallest members: more of equal score can't be among the k nearest
    small = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(small)).where(F.col("n") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes.withColumn("cls", F.xxhash64("v")), "classes")
    sample = [r.v for r in classes.orderBy("cls").limit(PIVOTS).select("v").collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = scaled(np.array(sample, np.float64))
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    near = min(NEAR, len(pivots))
    asked = stored(rows.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.xxhash64("v").alias("q")).distinct(), "queries")
    index, n = blocks(classes.select(F.col("cls").alias("id"), F.get("ids", F.lit(0)).alias("first"), "v"), BLOCK, pivots, near, "index")
    queries, _ = blocks(asked.select(F.col("q").alias("id"), F.col("q").alias("first"), "v").distinct(), QUERY_BLOCK, pivots, near, "query-blocks")
    # a member among the k + 1 nearest is of a class among the k + 1 nearest, as each class has its least member
    order = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    best = searched(together(queries, index, n), near, min(QUERY_NEAR, near), k + 1).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    each = best.join(classes.select("cls", "ids"), "cls").select("q", "score", F.explode("ids").alias("vec_id")).distinct()
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = each.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    out = asked.join(lists, "q").select(F.col("vec_id").alias("query_id"), F.expr(f"slice(filter(found, x -> x.vec_id <> vec_id), 1, {k})").alias("found"))
    return out.select("query_id", F.posexplode("found").alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
