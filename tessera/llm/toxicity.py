"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression (operator 4).

Training uses labelled rows only: at most about ``SAMPLE`` of them (a documented bound; chosen by a
hash, so the same rows every time). Of these, one part fits the lexicon and the trees, the other
the calibration. The lexicon holds the words whose presence speaks for the label by a z-value of the log
odds of documents holding them above ``Z`` (about one word in 700 passes by chance), the best ``LEXICON``
if there are more. A text is then known only by its features:
densities of lexicon words in the text and in its densest window, their nearness to the second
person, rates of capitals, punctuation and lengthened or obfuscated words, and lexicon words that
appear once obfuscation is undone. Language, source, ids and labels are no features.

The score is the calibrated probability, with ``RAW_SHARE`` of the trees' own so that the order
inside a calibration step is kept. Features are computed per row in tasks that hold about 1 MB of
text; nothing is shuffled when scoring.

Defined results: NULL and empty texts have all-zero features and a score; conflicting or repeated
labels count as they are; NULL labels are ignored; without both classes among the labels every
score is the label's mean (0 without labels); repeated rows give repeated results; other columns
pass through, and new columns replace old ones of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, written

SAMPLE = 20_000      # labelled rows used for training, about
LEXICON = 5_000      # words at most; the z-value decides below that
Z = 3.0              # least z-value of a lexicon word
MIN_DOCUMENTS = 5    # labelled documents that hold a lexicon word
TREES, DEPTH, STEP = 24, 4, 0.3
CALIBRATION = 4      # one row in so many fits the calibration
RAW_SHARE = 0.01
WINDOW = 50          # words of the densest window
NEAR = 5             # words between the second person and a lexicon word

SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton tes vous votre vos "
                          "tú usted ustedes vosotros".split())
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][0-9@$*+|!]+[^\W\d_]")
_SPELLED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .*_-][^\W\d_]){3,}(?![^\W_])")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_LEET = str.maketrans("013457@$!+|", "oieastasitl")
FEATURES = ["words", "density", "weight", "hits", "distinct", "densest", "second", "near", "capitals", "shouted",
            "exclaimed", "asked", "punctuated", "long", "mixed", "spelled", "undone"]


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    raw = text.encode("utf-8", "replace")
    n_bytes = max(1, len(raw))
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    hits = [i for i, w in enumerate(words) if w in lexicon]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        s = np.array(second)
        gap = np.minimum(np.abs(s[np.minimum(at, len(s) - 1)] - hits), np.abs(s[np.maximum(at - 1, 0)] - hits))
        near = int((gap <= NEAR).sum())
    densest = 0
    if hits:
        h = np.array(hits)
        densest = int((np.searchsorted(h, h + WINDOW) - np.arange(len(h))).max())
    # the words once letters are put back for signs, lengthening is cut and spelling joined
    mixed, spelled, long = _MIXED.findall(low), _SPELLED.findall(low), _LONG.findall(low)
    undone = 0
    if mixed:
        undone += max(0, sum(w in lexicon for w in _WORD.findall(low.translate(_LEET))) - len(hits))
        undone += max(0, sum(w in lexicon for w in _WORD.findall(low.replace("*", ""))) - len(hits))
    if long:
        undone += max(0, sum(w in lexicon for w in _WORD.findall(_LONG.sub(r"\1", low))) - len(hits))
    for x in spelled:
        undone += re.sub(r"[ .*_-]", "", x) in lexicon
    shouted = sum(len(w) > 1 and w.isupper() for w in _WORD.findall(text)) if bytes_[65:91].sum() * 20 > n_bytes else 0
    return [float(np.log1p(len(words))), len(hits) / n, sum(lexicon[words[i]] for i in hits) / n, float(np.log1p(len(hits))),
            float(len({words[i] for i in hits})), densest / min(n, WINDOW), len(second) / n, near / max(1, len(hits)),
            float(bytes_[65:91].sum() / n_bytes), shouted / n, float(bytes_[33] / n_bytes), float(bytes_[63] / n_bytes),
            float((bytes_[33:48].sum() + bytes_[58:65].sum()) / n_bytes), len(long) / n, len(mixed) / n, len(spelled) / n, undone / n]


def with_features(docs: DataFrame, lexicon: dict[str, float], text: str = "text", out: str = "features") -> DataFrame:
    keep = docs.select(*[c for c in docs.columns if c != out])
    names, words = keep.columns, docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON entries
    schema = T.StructType([*keep.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            each = [features(t or "", words.value) for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(each, pa.list_(pa.float64()))], names=[*names, out])

    return keep.mapInArrow(run, schema)


def learn_lexicon(labelled: DataFrame, size: int = LEXICON, min_documents: int = MIN_DOCUMENTS,
                  least: float = Z) -> dict[str, float]:
    """Words of ``labelled`` (``text, label``) with a z-value above ``least`` and their log odds; ``size`` at most."""
    held = labelled.select("label", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    n = labelled.agg(F.sum("label"), F.count(F.lit(1))).first()
    pos, neg = n[0], n[1] - n[0]
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (pos - a + 0.5)) - F.log((b + 0.5) / (neg - b + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (pos - a + 0.5) + 1 / (b + 0.5) + 1 / (neg - b + 0.5))
    top = (held.filter("word <> ''").groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
           .filter(a + b >= min_documents).select("word", odds.alias("odds"), z.alias("z")).filter(F.col("z") > least)
           .orderBy(F.desc("z"), "word").limit(size))
    return {r["word"]: r["odds"] for r in top.collect()}


class Model:
    """Lexicon, trees and calibration; ``score`` adds a probability to documents."""

    def __init__(self, mean: float, lexicon: dict[str, float] | None = None, trees=None, calibration=None):
        self.mean, self.lexicon, self.trees, self.calibration = mean, lexicon or {}, trees, calibration

    def score(self, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        if self.trees is None:
            return docs.select(*[c for c in docs.columns if c != out], F.lit(float(self.mean)).alias(out))
        return _apply(self.trees, self.calibration, with_features(docs, self.lexicon, text, "_features"), out).drop("_features")


def _probability(trees, df: DataFrame) -> DataFrame:
    """``df`` with ``_p``, the trees' probability from the array ``_features``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    done = trees.transform(df.withColumn("_vector", array_to_vector("_features")))
    return done.withColumn("_p", vector_to_array("_probability")[1]).drop("_vector", "_raw", "_probability", "_predicted")


def _apply(trees, calibration, df: DataFrame, out: str) -> DataFrame:
    done = calibration.transform(_probability(trees, df)).withColumn("_s", (1 - RAW_SHARE) * F.col("_c") + RAW_SHARE * F.col("_p"))
    return done.select(*[c for c in df.columns if c != out], F.least(F.greatest(F.col("_s"), F.lit(0.0)), F.lit(1.0)).alias(out))


def fit(labelled: DataFrame, choose: Column, sample: int = SAMPLE, seed: int = 7) -> Model:
    """Fit on ``labelled`` (``text, label`` 0 or 1). ``choose``: a non-negative hash that picks and parts the rows."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import IsotonicRegression

    rows = labelled.filter("label IS NOT NULL").withColumn("_h", choose)
    n = rows.count()
    rows = rows.filter(F.pmod(F.floor(F.col("_h") / 64), F.lit(1 << 20)) < int(min(1.0, sample / max(1, n)) * (1 << 20)))
    rows = written(rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"),
                               (F.pmod("_h", F.lit(CALIBRATION)) == 0).alias("calibrate")))
    own = rows.filter(~F.col("calibrate"))
    classes = own.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not classes[0] or classes[0] == classes[1]:
        return Model(classes[0] / classes[1] if classes[1] else 0.0)
    lexicon = learn_lexicon(own)
    found = written(with_features(rows, lexicon, "text", "_features").drop("text"))
    from pyspark.ml.functions import array_to_vector

    trees = GBTClassifier(featuresCol="_vector", labelCol="label", predictionCol="_predicted",
                          maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=seed, minInstancesPerNode=5
                          ).fit(found.filter(~F.col("calibrate")).withColumn("_vector", array_to_vector("_features")))
    trees.setFeaturesCol("_vector").setRawPredictionCol("_raw").setProbabilityCol("_probability")
    rest = _probability(trees, found.filter("calibrate"))
    if rest.limit(1).count() == 0:
        rest = _probability(trees, found)
    calibration = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_c").fit(rest.select("_p", F.col("label").cast("double")))
    return Model(classes[0] / classes[1], lexicon, trees, calibration)
