"""A training corpus from `documents`: language, lines, near copies, mix, sequences.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm._common import set_aside, small_or_shuffled, stored
from ledgerline.llm.op1_packing import packed
from ledgerline.llm.op2_language import in_known_language
from ledgerline.llm.op3_minhash import near_duplicates
from ledgerline.llm.op4_line_dedup import deduplicated
from ledgerline.llm.op6_mixing import mixed

#: SQL can express neither the classifier nor the sketches; tests hold the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be determined.

    Null, empty and letterless texts are in none and go; rows that repeat stay or go together; with no labelled row, all
    go; an empty table gives an empty one; all columns pass through.
    """
    rows, back = set_aside(docs, {"lang_pred", "score"})
    return in_known_language(rows).withColumnsRenamed(back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that occur in no earlier place; those that lose all their lines go.

    n_chars follows the text where lines went and is left alone elsewhere. Null and empty texts stay as they are; of equal
    lines the first by doc_id and place stays; rows that repeat doc_id and text get the same text; null doc_ids come first;
    an empty table gives an empty one. Any other columns pass through, those named n_lines or n_dropped included.
    """
    rows, back = set_aside(docs, {"n_lines", "n_dropped"})
    kept = deduplicated(rows).where("n_dropped = 0 OR text RLIKE '[^\\\\s]'")
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).drop("n_lines", "n_dropped").withColumnsRenamed(back)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id.

    Null, empty and wordless texts and null doc_ids are in no group and stay; rows that repeat a doc_id stay or go together;
    of equal texts the smallest doc_id stays; an empty table gives an empty one; all columns pass through.
    """
    gone = stored(near_duplicates(docs.select("doc_id", "text"), k=5, percent=80).where("NOT kept").select("doc_id").distinct(), "near-copies")
    return docs.join(small_or_shuffled(gone, 16), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last pass over a source ends with the document that meets its budget.

    Null and wordless texts have no size and are not taken; a null source is one source; rows that repeat a doc_id follow
    one another in the mix; an empty table gives an empty one; all columns pass through, those named like the mix's too.
    """
    rows, back = set_aside(docs, {"size", "source_size", "target", "taken", "copy"})
    times = F.expr("CAST(ceil(taken / size) AS INT)")
    taken = mixed(rows).where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return taken.drop("size", "source_size", "target", "taken", "copy").withColumnsRenamed(back)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens.

    Null and empty texts are a piece of one token, the end; rows that repeat are packed each; an empty table gives an
    empty result.
    """
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near copies", near_copies),
    ("mix", mix),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents at sf_dir, each stored and read again; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
