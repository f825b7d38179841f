"""Toxicity of whole texts: boosted trees over dense features, calibrated.

The lexicon is learned: words and word beginnings that labelled toxic documents
have far more often than others. The features of a document are densities of its
hits, their proximity to second persons, and rates of capitals, punctuation and
obfuscation. Gradient-boosted trees learn from most of the labelled rows, an
isotonic regression on the rest turns their margin into a probability.

Lexicon and trees learn from a bounded sample of the labelled rows, ``SAMPLE``
rows with the smallest hash of their id. All else covers all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import WORD_RE, bounded, cut, null_safe_join, packed, text_hash, with_id, without_null, words

SAMPLE = 20_000
#: Entries of the lexicon, at most.
LEXICON = 4_000
#: Letters of word beginnings.
_STEMS = (4, 5, 6, 7)
_LONGEST = 40
#: Twice the log-likelihood ratio from which an entry is no accident among some
#: hundred thousand candidates (a chance of about one in a hundred thousand).
_EVIDENCE = 20.0
#: Second persons of some languages; a fixed list.
SECOND_PERSONS = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes"
    " vous votre vos usted ustedes tus vosotros vosotras os vuestro vuestra".split()
)
NEAR = 5

FEATURES = (
    "strong",  # hits of entries that clean documents hardly have
    "strong_density",
    "weak",  # hits of the other entries
    "weak_density",
    "evidence",  # the largest log-odds among the hits
    "evidence_sum",  # of different hits
    "kinds",  # different hits
    "second_near",  # share of hits with a second person nearby
    "capitals",
    "punctuation",
    "obfuscated",  # share of words with marks or digits inside
    "n_words",
)


class _Lexicon(dict):
    """Log-odds of words by the longest entry that fits; remembers a bounded number."""

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        score = self.entries.get(word, 0.0) if len(word) <= _LONGEST else 0.0
        for n in _STEMS:
            if len(word) > n:
                score = max(score, self.entries.get(word[:n] + "*", 0.0))
        self[word] = score
        return score


STRONG = 5.0


def describer(entries: dict[str, float]) -> Callable:
    """(doc_id, doc, text) to (doc_id, doc, features)."""

    def described(text: str | None, lexicon: _Lexicon, kinds: np.ndarray) -> tuple[float, ...]:
        text = text or ""
        found = WORD_RE.findall(text.lower())
        n = len(found)
        scores = list(map(lexicon.__getitem__, found))
        hits = [i for i, s in enumerate(scores) if s] if any(scores) else []
        strong = sum(scores[i] >= STRONG for i in hits)
        different = {found[i]: scores[i] for i in hits}
        near = 0
        for i in hits:
            near += not SECOND_PERSONS.isdisjoint(found[max(0, i - NEAR) : i + NEAR + 1])
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        count = np.bincount(kinds[raw], minlength=4)
        inside = 0
        if len(raw) > 2:
            k = kinds[raw]
            # A mark or digit right between two letters.
            inside = int(((k[1:-1] == 2) & (k[:-2] <= 1) & (k[2:] <= 1)).sum())
        chars = max(1, len(raw))
        return (
            float(strong),
            strong / max(1, n),
            float(len(hits) - strong),
            (len(hits) - strong) / max(1, n),
            max(different.values(), default=0.0),
            min(50.0, sum(different.values())),
            float(len(different)),
            near / max(1, len(hits)),
            count[1] / chars,
            count[2] / chars,
            inside / max(1, n),
            float(n),
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = _Lexicon(entries)
        # 0 letters, 1 capitals, 2 marks and digits, 3 spaces; bytes beyond ASCII are letters.
        kinds = np.full(256, 2, np.uint8)
        kinds[[9, 10, 11, 12, 13, 32]] = 3
        kinds[ord("a") : ord("z") + 1] = 0
        kinds[ord("A") : ord("Z") + 1] = 1
        kinds[128:] = 0
        for frame in frames:
            rows = [described(t, lexicon, kinds) for t in frame["text"]]
            out = pd.DataFrame(rows, columns=list(FEATURES), dtype="float64")
            out.insert(0, "doc", frame["doc"])
            out.insert(0, "doc_id", frame["doc_id"])
            yield out

    return run


def held_out() -> F.Column:
    """Documents whose labels are never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def training_rows(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` labelled rows (doc_id, toxic, part), one per document, in the
    order of a hash of the id; part 0 of 5 calibrates. Documents with contradicting
    labels count as toxic."""
    usable = labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
    one = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    return cut(
        one.orderBy(order, "doc_id")
        .limit(size)
        .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5)).cast("int"))
    )


def learn_lexicon(docs: DataFrame, rows: DataFrame, entries: int = LEXICON) -> dict[str, float]:
    """Words and word beginnings ("stem*") with their log-odds, at least three, from the
    different texts of the training rows. Bounded by ``entries``, so it may come to
    the driver."""
    # Rows of one id are one document, the text with the smallest hash.
    own = docs.select("doc_id", "text", text_hash().alias("doc")).join(
        F.broadcast(rows.filter("part <> 0")), "doc_id"
    )
    own = own.groupBy("doc_id").agg(F.min_by("text", "doc").alias("text"), F.max("toxic").alias("toxic"))
    texts = cut(
        own.groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("_text"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    per_doc = texts.select("toxic", F.array_distinct(words(F.col("text"))).alias("_words"))
    stems = [
        F.transform(
            F.filter("_words", lambda w, n=n: F.char_length(w) > n),
            lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")),
        )
        for n in _STEMS
    ]
    short = F.filter("_words", lambda w: F.char_length(w) <= _LONGEST)
    totals = texts.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic, clean = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    if not toxic or not clean:
        return {}
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    base = toxic / (toxic + clean)
    n = F.col("t") + F.col("c")

    def part(seen: F.Column, share: float) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0)

    found = (
        per_doc.select("toxic", F.explode(F.array_distinct(F.concat(short, *stems))).alias("entry"))
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .withColumn("odds", odds)
        .filter(F.col("odds") >= 3)
        .filter(2 * (part(F.col("t"), base) + part(F.col("c"), 1 - base)) >= _EVIDENCE)
        .orderBy(F.col("t").desc(), F.col("odds").desc(), "entry")
        .limit(entries)
        .collect()
    )
    return {r["entry"]: float(r["odds"]) for r in found}


class ToxicityModel:
    """A fitted lexicon, trees and calibration."""

    def __init__(self, entries: dict[str, float], trees, calibration, constant: float = 0.0):
        self.entries, self.trees, self.calibration = entries, trees, calibration
        self.constant = constant

    def features(self, docs: DataFrame) -> DataFrame:
        ddl = ", ".join(f"{c} double" for c in FEATURES)
        rows = docs.select(without_null("doc_id"), text_hash().alias("doc"), "text")
        return with_id(
            rows.mapInPandas(describer(self.entries), f"doc_id long, doc long, {ddl}")
        )

    def scored(self, features: DataFrame) -> DataFrame:
        """doc_id, doc (hash of the text) and score of each row of features."""
        if self.trees is None:
            return features.select("doc_id", "doc", F.lit(self.constant).alias("score"))
        margins = _margins(self.trees, features)
        probability = self.calibration.transform(margins)
        score = F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0))
        return probability.select("doc_id", "doc", score.alias("score"))


def _margins(trees, features: DataFrame) -> DataFrame:
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
    raw = vector_to_array(F.col("rawPrediction"))[1]
    return trees.transform(ready).withColumn("margin", raw)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[ToxicityModel, DataFrame]:
    """A model and the features of all documents. With labels of one kind only, or
    none, there is nothing to learn: every score is then that kind, or 0."""
    rows = training_rows(labels, size)
    entries = learn_lexicon(docs, rows)
    model = ToxicityModel(entries, None, None)
    features = cut(model.features(docs))
    # One row for each labelled id, so that there are at most ``size``.
    known = features.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic", "part")
    known = known.agg(F.min_by(F.struct(*FEATURES), "doc").alias("_row"))
    known = cut(known.select("doc_id", "toxic", "part", "_row.*").repartition(4))
    kinds = {(r["part"] == 0, r["toxic"]) for r in known.select("part", "toxic").distinct().collect()}
    learned = {t for calibrates, t in kinds if not calibrates}
    if len(learned) < 2:
        model.constant = float(max(learned, default=0))
        return model, features
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        known.withColumn("label", F.col("toxic").cast("double"))
    )
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, seed=17
    ).fit(ready.filter("part <> 0"))
    # With no row to calibrate on, the rows of the trees serve.
    rest = known.filter("part = 0") if any(calibrates for calibrates, _ in kinds) else known
    calibration = IsotonicRegression(
        featuresCol="margin", labelCol="toxic", predictionCol="calibrated"
    ).fit(
        _margins(trees, rest).select("margin", F.col("toxic").cast("double").alias("toxic"))
    )
    return ToxicityModel(entries, trees, calibration), features


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored by the features of an empty text. Rows with the
    same id are scored each by their own text; a null id is not held out.
    """
    model, features = fit(docs, labels)
    return model.scored(features).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those whose text scores 0.5 or more; all columns are kept."""
    model, features = fit(docs, labels)
    toxic = model.scored(features).filter("score >= 0.5").select("doc_id", "doc").distinct()
    rows = packed(docs, "doc_id", text_hash().alias("doc"))
    return null_safe_join(rows, bounded(cut(toxic)), ["doc_id", "doc"], "left_anti").select("_row.*")
