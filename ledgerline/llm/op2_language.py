"""Language identification in two steps: the family by one-versus-rest, the language within it by one-versus-one linear SVMs.

Features are hashed counts of 1 to 3 bytes over lower-cased letters, square-rooted and scaled to length 1. The SVMs are
fitted in Spark tasks, one problem a task, on a bounded sample of labelled rows; every text is predicted as a whole.

The SVMs only choose among the languages learned. Whether a text is in one of them at all is told by its mean log
likelihood under each language's counts, which are of all labelled rows that are not held out, against what all labelled
rows that are held out reach.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._common import in_batches, stored, texts

BITS, BLOCK = 12, 1 << 19
#: Labelled rows of each language that are fitted on, by hash order.
SAMPLE_PER_LANGUAGE = 400
#: How many times the sample is let through to be sorted, and the range of hashes.
OVERSAMPLED, HASHES = 4, 1 << 40
UNDETERMINED = "und"
#: A text is unknown if its mean log likelihood is under each language's own by over `slack` * sqrt(1 / letters + 1 / SPREAD).
#: slack is MARGIN times what all but SPARED of the labelled rows held out of any language stay within, LEAST_SLACK at least.
SPREAD, MARGIN, SPARED, LEAST_SLACK = 100, 2.0, 0.005, 5.0
#: Units of a squared feature, which are summed as whole numbers.
UNITS = 1 << 32
#: Language families by ISO 639-1 code; a language in none is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga cy gd br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi ur bn pa gu mr ne si",
    "iranian": "fa ku ps tg",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "sinitic": "zh yue",
    "austronesian": "id ms tl jv",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# letters a-z and all bytes of other scripts stay, A-Z are lower-cased, the rest is white space
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def features(text: bytes) -> np.ndarray:
    """Vector of 2 ** BITS floats, length 1; zero if nothing is left of the text."""
    data = b" " + b" ".join(text.translate(_TABLE).split()) + b" "
    counts = np.zeros(1 << BITS)
    for at in range(0, len(data), BLOCK):
        a = np.frombuffer(data[at : at + BLOCK + 2], np.uint8).astype(np.uint32)
        key = a
        for n in range(1, min(3, len(a)) + 1):
            if n > 1:
                key = (key[: len(a) - n + 1] << np.uint32(8)) | a[n - 1 :]
            own = key[:BLOCK]  # what starts in the next block counts there
            counts += np.bincount(((own + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    x = np.sqrt(counts)
    return (x / max(np.linalg.norm(x), 1e-9)).astype(np.float32)


def letters(text: bytes) -> int:
    return len(b"".join(text.translate(_TABLE).split()))


def deviation(text: bytes, x: np.ndarray, likely: np.ndarray, own: np.ndarray) -> float:
    """How far the features x of text are under the language they fit best, as a multiple of what chance does to a text of its length."""
    best = float((likely @ (x * x) - own).max())
    return -best / np.sqrt(1 / max(1, letters(text)) + 1 / SPREAD)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, passes: int = 30) -> np.ndarray:
    """Weights of a linear SVM (squared hinge loss, last weight the bias) by dual coordinate descent; y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    soft = 1 / (2 * cost * share)
    norms = (x * x).sum(1) + soft
    alpha, w, order = np.zeros(len(x)), np.zeros(x.shape[1]), np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(x)):
            new = max(0.0, alpha[i] - (y[i] * (w @ x[i]) - 1 + soft[i] * alpha[i]) / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def chosen_rows(usable: DataFrame, per_language: int) -> DataFrame:
    """Rows (doc_id) of the per_language least by hash of each lang of usable (doc_id, lang).

    Languages are counted first, and only rows under a bound on the hash that lets about OVERSAMPLED times as many through
    are sorted, so that no task gets more rows of a language as the table grows.
    """
    hashed = usable.withColumn("h", F.expr(f"pmod(xxhash64(doc_id), {HASHES}L)"))
    # one row a language: as few as the model has
    bounds = usable.groupBy("lang").agg(F.count("*").alias("rows")).withColumn("bound", F.expr(f"{HASHES}D * least(1D, {OVERSAMPLED * per_language}D / rows)"))
    near = hashed.join(F.broadcast(bounds.select("lang", "bound")), "lang").where("h <= bound")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    return near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("doc_id").distinct()


def fitted(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """Model of rows (doc_id, text, lang): weights of each family against the others and of each pair within a family."""
    usable = labelled.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    chosen = chosen_rows(usable.select("doc_id", "lang"), per_language)
    # at most per_language ids a language: small by that bound
    sample = usable.join(F.broadcast(chosen), "doc_id", "left_semi")

    def vectors(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([features(t).tobytes() for t in texts(batch)], pa.binary())], ["lang", "x"])

    points = stored(sample.select("text", "lang").mapInArrow(vectors, "lang string, x binary"), "language-sample")
    langs = sorted(r.lang for r in points.select("lang").distinct().collect())
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(family(lang), []).append(lang)
    problems = [(f"family {f}", lang, 1 if lang in own else -1) for f, own in groups.items() for lang in langs if len(groups) > 1]
    problems += [(f"pair {a} {b}", lang, y) for own in groups.values() for a, b in itertools.combinations(own, 2) for lang, y in ((a, 1), (b, -1))]
    weights: dict[str, np.ndarray] = {}
    if problems:

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("x")
            x = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]])
            return pd.DataFrame({"problem": rows["problem"].iloc[:1], "w": [svm(x, rows["y"].to_numpy()).astype(np.float32).tobytes()]})

        table = labelled.sparkSession.createDataFrame(problems, "problem string, lang string, y int")
        done = points.join(F.broadcast(table), "lang").select("problem", "y", "x").groupBy("problem").applyInPandas(fit, "problem string, w binary")
        weights = {r.problem: np.frombuffer(r.w, np.float32) for r in done.collect()}
    return {"groups": groups, "weights": weights}


def shares(labelled: DataFrame) -> dict[str, np.ndarray]:
    """The mean squared features of the texts of each lang of labelled (text, lang), all rows counted.

    Whole UNITS are summed in tasks, then by language and feature, so that neither the number of rows nor their order matters.
    """

    def summed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                own = sums.setdefault(lang, np.zeros(1 << BITS, np.int64))
                own += np.rint(features(text).astype(np.float64) ** 2 * UNITS).astype(np.int64)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at])], ["lang", "at", "units"])

    found: dict[str, np.ndarray] = {}
    # at most 2 ** BITS numbers a language
    for r in labelled.select("lang", "text").mapInArrow(summed, "lang string, at long, units long").groupBy("lang", "at").agg(F.sum("units").alias("units")).collect():
        found.setdefault(r.lang, np.zeros(1 << BITS))[r.at] = r.units
    return {lang: own / own.sum() for lang, own in found.items()}


def calibrated(model: dict, known: DataFrame, held: DataFrame) -> dict:
    """The model with `likely` (a row of log likelihoods a language), `own` (what a language's texts reach) and slack.

    known and held: rows (text, lang) of the languages learned, to count and to hold against the counts; every row of both
    that has a letter is read.
    """
    if not model["groups"]:
        return model
    langs = [lang for group in model["groups"].values() for lang in group]
    usable = F.col("lang").isin(langs) & F.expr("text RLIKE '\\\\p{L}'")
    by = np.stack([x + 1e-6 for _, x in sorted(shares(known.where(usable)).items())])
    by /= by.sum(1, keepdims=True)
    likely = np.log(by)
    own = (likely * by).sum(1)

    def deviations(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([float(deviation(t, features(t), likely, own)) for t in texts(batch)], pa.float64())], ["lang", "far"])

    # by thousandths, so that a percentile is of a bounded number of values however many rows there are
    far = held.where(usable).select("lang", "text").mapInArrow(deviations, "lang string, far double").groupBy("lang", F.round("far", 3).alias("far")).agg(F.count("*").alias("n"))
    far = far.groupBy("lang").agg(F.expr(f"percentile(far, {1 - SPARED}, n)").alias("far")).agg(F.max("far").alias("far")).first().far
    return model | {"likely": likely, "own": own, "slack": max(LEAST_SLACK, MARGIN * (far or 0.0))}


def _chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-4 * margin)))


def predicted(docs: DataFrame, model: dict, carried: list[str]) -> DataFrame:
    """The carried columns of docs (text and others), with lang_pred and score of each text.

    With a calibrated model, texts in none of its languages are undetermined.
    """
    groups, weights = model["groups"], model["weights"]
    model = {k: model[k] for k in ("likely", "own", "slack") if k in model}
    families, problems = list(groups), list(weights)

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        letter = regex.compile(r"\p{L}")
        w = np.stack([weights[p] for p in problems]) if problems else np.zeros((0, (1 << BITS) + 1), np.float32)

        def one(text: bytes) -> tuple[str, float]:
            if not groups or not letter.search(text.decode("utf-8", "replace")):
                return UNDETERMINED, 0.0
            x = features(text)
            if "slack" in model and deviation(text, x, model["likely"], model["own"]) > model["slack"]:
                return UNDETERMINED, 0.0
            margins = dict(zip(problems, w[:, :-1] @ x + w[:, -1], strict=True))
            best, score = families[0], 1.0
            if len(families) > 1:
                best = max(families, key=lambda f: margins[f"family {f}"])
                score = _chance(margins[f"family {best}"])
            votes = dict.fromkeys(groups[best], 0)
            sums = dict.fromkeys(groups[best], 0.0)
            for a, b in itertools.combinations(groups[best], 2):
                m = margins[f"pair {a} {b}"]
                votes[a if m > 0 else b] += 1
                sums[a] += m
                sums[b] -= m
            lang = max(votes, key=lambda x: (votes[x], sums[x]))
            return lang, score * (_chance(sums[lang] / (len(votes) - 1)) if len(votes) > 1 else 1.0)

        for batch in batches:
            found = [one(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*carried, "lang_pred", "score"])

    own = docs.select(*dict.fromkeys([*carried, "text"]))
    kinds = own.select(*carried).schema.add("lang_pred", "string").add("score", "double")
    return own.mapInArrow(predict, kinds)


HELD_OUT = "coalesce(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2, false)"


def identified(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Fitted on rows with a lang that are not held out (crc32 of doc_id as text, modulo 4, is 2). Defined results: texts
    that are null or have no letter are 'und' with score 0, and so are all if no row has a label; a language without
    others in its family is decided by the family alone; rows with a null doc_id are not held out; repeated rows are
    predicted alike; an empty table gives an empty result; other columns are not read.
    """
    in_batches(docs.sparkSession)
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) doc_id", "text", "lang", f"{HELD_OUT} held_out")
    return predicted(rows, fitted(rows.where("NOT held_out"), per_language), ["doc_id", "held_out"])


def in_known_language(docs: DataFrame, least: float = 0.25, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of docs (doc_id, text, lang and any others but lang_pred and score) whose language is determined.

    Rejected are texts that are 'und' or whose score is under `least`; the rest stay with all their columns. 'und' are
    texts without a letter, and those that no learned language explains as well as it does its own labelled rows that
    are held out (or its other ones, if none is).
    """
    in_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    known = docs.where(f"NOT ({HELD_OUT})").select("doc_id", "text", "lang")
    held = docs.where(HELD_OUT).select("doc_id", "text", "lang")
    if not held.where("lang IS NOT NULL").head(1):
        held = known
    rows = predicted(docs, calibrated(fitted(known, per_language), known, held), docs.columns)
    return rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*docs.columns)
