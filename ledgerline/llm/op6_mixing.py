"""Mixing sources to target weights, in DataFrame functions only.

Documents get hash-random keys; within a source they are ordered by key, which is dealt in key ranges: sums of ranges are
accumulated first, then each range is numbered on its own, so that a hot source is never one group. Each source is cut at
its budget exactly; budgets over the source's size repeat it in whole passes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._common import set_aside

#: Hexadecimal digits of the key that name a range: 4,096 ranges a source.
RANGE_DIGITS = 3
WORDS = r"[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> F.Column:
    """Number of runs of characters other than ASCII white space; null counts 0."""
    return F.expr(f"CAST(coalesce(regexp_count({text}, '{WORDS}'), 0) AS BIGINT)")


def budgets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Rows (source, source_size, target) of sizes (source, source_size): weights repeat over the sources by code point, null last.

    Targets share the total by weight; those above most times their size stop there and the others share the rest, until
    none is above. In rising order of cap / weight the stopped sources are a prefix: source i stops if its cap is at most
    its share of what the sources before it, all stopped, leave.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    pick = "element_at(array({}), CAST((i - 1) % {} + 1 AS INT))".format(", ".join(f"{w}D" for w in weights), len(weights))
    s = sizes.withColumn("i", F.row_number().over(order)).withColumn("w", F.expr(pick)).withColumn("cap", F.col("source_size") * most)
    rise = Window.orderBy(F.col("cap") / F.col("w"), "i")
    ahead, back = rise.rowsBetween(Window.unboundedPreceding, -1), rise.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))).withColumn("shared_w", F.sum("w").over(back))
    s = s.withColumn("level", F.col("rest") / F.col("shared_w"))
    s = s.withColumn("stops", F.col("cap") <= F.col("level") * F.col("w"))
    # the level of the first source that does not stop is that of all after it
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(whole)
    return s.select("source", "source_size", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.least(level * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """docs (doc_id, text, source and any others but the new names) with size, source_size, target and taken.

    taken is what the mix takes of a document in words: whole passes over its source, and in the last pass what lies
    before the source's budget in the order of hash-random keys. Defined results: null texts have size 0; null sources
    are one source, the last; rows that repeat a doc_id follow one another in the order; an empty table gives an empty
    result; columns of the new names are replaced.
    """
    docs, back = set_aside(docs.drop("size", "source_size", "target", "taken"), {"_key", "_range", "_none", "_source", "_own", "_ahead"})
    rows = docs.withColumn("size", word_count())
    rows = rows.withColumn("_key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    rows = rows.withColumn("_range", F.substring("_key", 1, RANGE_DIGITS)).withColumn("_none", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))
    parts = rows.groupBy("_none", "_source", "_range").agg(F.sum("size").alias("part_size"))
    sizes = parts.groupBy("_none", "_source").agg(F.sum("part_size").alias("source_size"))
    plan = budgets(sizes.select(F.when(~F.col("_none"), F.col("_source")).alias("source"), "source_size"), weights, most)
    plan = plan.select(F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_source"), "source_size", "target")
    before = Window.partitionBy("_none", "_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_ahead", F.coalesce(F.sum("part_size").over(before), F.lit(0))).drop("part_size").join(plan, ["_none", "_source"])
    own = Window.partitionBy("_none", "_source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_own", F.coalesce(F.sum("size").over(own), F.lit(0))).join(starts, ["_none", "_source", "_range"])
    budget = "CAST(round(target) AS BIGINT)"
    passes = f"CASE WHEN source_size > 0 THEN {budget} div source_size ELSE 0L END"
    cut = f"greatest(0L, least(size, {budget} - ({passes}) * source_size - _ahead - _own))"
    return placed.withColumn("taken", F.expr(f"({passes}) * size + {cut}")).drop("_key", "_range", "_none", "_source", "_own", "_ahead").withColumnsRenamed(back)
