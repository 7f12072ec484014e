"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of insults (a short list, and words and stems learned from the labels), how near they stand
to words addressing the reader, capitals, punctuation, and several ways of disguising words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import written
from claimloom.llm.labelled import labelled_sample, with_text_columns
from claimloom.llm.simhash import shingle_hashes

SAMPLE_ROWS = 20_000
LEARNED_TERMS = 300
STEM_LENGTHS = (4, 5, 6)
STEM_MARK = "*"
TREES = 20
DEPTH = 3
SEED = 5
THRESHOLD = 0.7
NEAR = 5
FEATURES = 16

# common insults; words that mark toxic texts of a corpus are learned besides
INSULTS = frozenset(
    "clown coward creep dirtbag disgusting dumb dumbass fool freak garbage idiot imbecile jerk lame loser lunatic "
    "moron pathetic pig psycho retard scum scumbag shame stupid trash ugly useless vermin worthless".split()
)
# words that address the reader, in the languages of the tables
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted vosotros".split()
)
WORD = re.compile(r"\w+")
DISGUISED = re.compile(r"\b\w*[^\W\d_][0-9@$!*_.\-]+[^\W\d_]\w*\b")
SPELLED = re.compile(r"\b(?:[^\W\d_][ .\-]){3,}[^\W\d_]\b")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
CAPITAL = np.zeros(256, dtype=bool)
CAPITAL[ord("A") : ord("Z") + 1] = True
DROPPED = re.compile(r"[*_.\- ]")


def plain(word: str) -> str:
    """A disguised word with look-alike signs read as letters and separators taken out."""
    return DROPPED.sub("", word.lower().translate(LOOKALIKE))


@dataclass(frozen=True)
class Terms:
    """Learned words, and stems of longer words."""

    words: frozenset[str]
    stems: frozenset[str]


def features(text: str | None, learned: Terms) -> np.ndarray:
    """Dense features of a whole text; null counts as empty, whose features are all zero."""
    text = text or ""
    found = np.zeros(FEATURES)
    words = WORD.findall(text.lower())
    if not words:
        return found
    count = len(words)
    insults = [at for at, word in enumerate(words) if word in INSULTS]
    taught = sum(1 for word in words if word in learned.words)
    stemmed = sum(1 for n in STEM_LENGTHS for word in words if len(word) > n and word[:n] in learned.stems)
    addressed = [at for at, word in enumerate(words) if word in SECOND_PERSON]
    near = 0
    if insults and addressed:
        place = np.array(addressed)
        next_one = np.searchsorted(place, insults)
        after = place[np.minimum(next_one, len(place) - 1)]
        before = place[np.maximum(next_one - 1, 0)]
        near = int((np.minimum(abs(after - insults), abs(before - insults)) <= NEAR).sum())
    disguised = DISGUISED.findall(text)
    decoded = [plain(word) for word in disguised]
    decoded += [plain(word) for word in SPELLED.findall(text)]
    letters = sum(map(len, words))
    found[:] = (
        np.log1p(count),
        len(insults) / count,
        np.log1p(len(insults)),
        taught / count,
        np.log1p(taught),
        stemmed / count,
        np.log1p(stemmed),
        len(addressed) / count,
        near,
        int(CAPITAL[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)].sum()) / letters,
        (text.count("!") + text.count("?")) / count,
        (text.count(",") + text.count(".") + text.count(";") + text.count(":")) / count,
        len(disguised) / count,
        sum(1 for word in decoded if word in INSULTS or word in learned.words),
        sum(1 for _ in STRETCHED.finditer(text)) / count,
        (len(text) - letters) / len(text),
    )
    return found


def all_features(texts: list[str | None], learned: Terms) -> np.ndarray:
    return np.array([features(text, learned) for text in texts]).reshape(len(texts), FEATURES)


def first_passage(text: str | None) -> float:
    """Smallest shingle hash: near copies of a text mostly share it, other texts hardly ever do."""
    hashes = shingle_hashes(text)
    return float(hashes.min()) if len(hashes) else 0.0


def learn_terms(sample: DataFrame, size: int = LEARNED_TERMS) -> Terms:
    """Words and stems that toxic documents of ``sample`` (``text, y``) hold far more often than others.

    Near copies count once, so that what one copied text happens to hold isn't taken for a mark.
    """
    once = with_text_columns(sample, lambda texts: [np.array([first_passage(text) for text in texts])], {"_first": "double"})
    once = written(once.dropDuplicates(["y", "_first"]).select("y", "text"), "toxicity-once")
    totals = once.agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    toxic, clean = totals[0], totals[1]
    if not toxic or not clean:
        return Terms(frozenset(), frozenset())
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"))

    def stems_of(length: int) -> Column:
        longer = F.filter("words", lambda word: F.char_length(word) > length)
        return F.transform(longer, lambda word: F.concat(F.substring(word, 1, length), F.lit(STEM_MARK)))

    stems = map(stems_of, STEM_LENGTHS)
    terms = once.select("y", words.alias("words")).select("y", F.explode(F.array_distinct(F.concat("words", *stems))).alias("term"))
    held = terms.filter("term <> ''").groupBy("term").agg(
        F.count_if(F.col("y") > 0).alias("in_toxic"), F.count_if(F.col("y") <= 0).alias("in_clean")
    )
    p1, p0 = F.col("in_toxic") / toxic, F.col("in_clean") / clean
    pooled = (F.col("in_toxic") + F.col("in_clean")) / (toxic + clean)
    z = (p1 - p0) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / clean))
    telling = held.withColumn("z", z).filter((F.col("in_toxic") >= 4) & (p1 >= 8 * p0) & (F.col("z") >= 5))
    found = [row["term"] for row in telling.orderBy(F.desc("z"), "term").limit(size).collect()]
    return Terms(
        frozenset(term for term in found if not term.endswith(STEM_MARK)),
        frozenset(term[: -len(STEM_MARK)] for term in found if term.endswith(STEM_MARK)),
    )


@dataclass
class ToxicityModel:
    """Learned words, trees and calibration. Without labels of both kinds every score is ``default``."""

    learned: Terms
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    default: float = 0.0


def _raw(frame: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    made = trees.transform(frame.withColumn("_vector", array_to_vector("_features")))
    return made.withColumn("_raw", vector_to_array("_probability")[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most about ``rows`` labelled documents for which ``learn`` holds."""
    sample = written(labelled_sample(docs, labels, label, learn, rows), "toxicity-texts")
    learned = learn_terms(sample)
    made = written(
        with_text_columns(sample, lambda texts: [all_features(texts, learned)], {"_features": "array<double>"}).select("_features", "y"),
        "toxicity-features",
    )
    if made.select("y").distinct().limit(3).count() < 2:
        return ToxicityModel(learned)
    booster = GBTClassifier(
        featuresCol="_vector", labelCol="y", predictionCol="_prediction",
        maxIter=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5,
    ).setProbabilityCol("_probability").setRawPredictionCol("_margin")
    trees = booster.fit(made.withColumn("_vector", array_to_vector("_features")))
    scored = _raw(made, trees).select(F.round("_raw", 3).alias("_raw"), "y").groupBy("_raw").agg(
        F.avg("y").alias("y"), F.count("y").cast("double").alias("n")
    )
    calibration = IsotonicRegression(featuresCol="_raw", labelCol="y", weightCol="n", predictionCol="_score").fit(scored)
    return ToxicityModel(learned, trees, calibration)


def with_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """``docs`` (any columns, with ``text``) and their toxicity score from 0 to 1, of whole texts.

    A null or empty text has all features zero and is scored like any other; repeated rows are scored
    alike; an empty table gives no rows.
    """
    if model.trees is None:
        return docs.withColumn(score, F.lit(model.default))
    learned = model.learned
    # given columns are packed, so that none can clash with working columns
    others = [name for name in docs.columns if name != score]
    packed = docs.select(F.struct(*(F.col(f"`{name}`") for name in others)).alias("_row"), "text")
    made = with_text_columns(packed, lambda texts: [all_features(texts, learned)], {"_features": "array<double>"}).drop("text")
    found = model.calibration.transform(_raw(made, model.trees))
    return found.select("_row.*", F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)).alias(score))
