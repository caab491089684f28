"""Toxicity by gradient-boosted trees over dense features of the whole text.

Features: densities of a lexicon of words and one of word beginnings, closeness
of lexicon words to a second person, shares of capitals and of punctuation, and
rates of obfuscation. The lexicons are learnt by log-odds from labelled texts,
the trees are Spark's own, and their margins are calibrated by an isotonic fit.

Lexicons, trees and calibration are learnt from bounded samples of labelled
rows. Trees and calibration weigh a sampled row by the labelled rows of its class
that it stands for, so a score means the same at any size. Scoring is one pass
over the texts.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.llm.common import checkpointed, fold, texts_of, with_columns, with_text

HELD_OUT_FOLD, FOLDS = 0, 5
# Labelled rows per class that are learnt from.
SAMPLE_PER_CLASS = 5_000
LEXICON_SIZE = 4_000
# Least log-odds of a term and least value of its G-test; chance terms stay far below.
LEAST_ODDS = 1.5
LEAST_G = 30.0
STEMS = (4, 5)
NEAR = 4
TREES, DEPTH = 20, 4
ROWS_PER_TASK = 1_000
CALIBRATION_SHARE = 4
_HELD_TERMS = 400_000

# Forms of the second person in English, German, French, Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves du dich dir dein deine ihr euch euer sie "
    "tu te toi ton ta tes vous vos votre tú ti usted ustedes vosotros".split()
)
# Characters that stand for letters in disguised words.
LOOKALIKES = str.maketrans("@4301!$57", "aaeoiisst")

FEATURES = (
    "log_words",
    "word_hits",
    "word_density",
    "word_weight",
    "strongest_word",
    "stem_hits",
    "stem_density",
    "strongest_stem",
    "disguised_hits",
    "second_person_density",
    "near_second_person",
    "capital_share",
    "shouted_words",
    "punctuation_share",
    "exclamation_share",
    "repeated_marks",
    "mixed_words",
)
_STRIP = string.punctuation + "¡¿«»„“”‘’…–—"
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in string.punctuation]] = True


def tokens_of(text: str) -> list[str]:
    """Lower-cased words between white space, without marks at their ends."""
    return [w.strip(_STRIP) for w in text.lower().split()]


def plain(word: str) -> str | None:
    """A disguised word in letters; None if it has no character that stands for one."""
    if word.isalpha():
        return None
    found = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
    return found if found and found != word else None


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, term, toxic texts, other texts): in how many texts a word or stem occurs."""

    def out() -> pa.RecordBatch:
        keys = {*counts[0], *counts[1]}
        kinds, terms = ([k[i] for k in keys] for i in (0, 1))
        numbers = [pa.array([counts[v][k] for k in keys], pa.int64()) for v in (1, 0)]
        names = ["kind", "term", "toxic", "other"]
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(terms, pa.string()), *numbers], names)

    counts = (Counter(), Counter())
    for batch in batches:
        for text, y in zip(batch.column("text"), batch.column("y"), strict=True):
            words = set(tokens_of(text.as_py() or ""))
            words |= {p for p in map(plain, words) if p}
            held = counts[y.as_py()]
            held.update(("word", w) for w in words if w)
            held.update({("stem", w[:n]) for w in words for n in STEMS if len(w) > n})
            if len(counts[0]) + len(counts[1]) > _HELD_TERMS:
                yield out()
                for c in counts:
                    c.clear()
    yield out()


def learn_lexicons(sample: DataFrame) -> dict[str, dict[str, float]]:
    """Log-odds of the words and stems that toxic texts of the sample hold far more often."""
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    schema = "kind string, term string, toxic long, other long"
    counts = sample.select("text", "y").mapInArrow(_term_batches, schema)
    counts = counts.groupBy("kind", "term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("other") + 0.5) / (other + 1.0))
    held = F.col("toxic") + F.col("other")
    share = max(1, toxic) / max(1, toxic + other)
    # 0 * log(0) counts as 0.
    g = sum(
        2 * F.col(c) * F.log(F.greatest(c, F.lit(1e-9)) / (held * p))
        for c, p in (("toxic", share), ("other", max(1e-9, 1 - share)))
    )
    ranked = counts.withColumns({"odds": odds, "g": g})
    ranked = ranked.where((F.col("odds") >= LEAST_ODDS) & (F.col("g") >= LEAST_G))
    ranked = ranked.orderBy(F.desc("g"), "kind", "term")
    lexicons: dict[str, dict[str, float]] = {"word": {}, "stem": {}}
    for r in ranked.limit(LEXICON_SIZE).collect():
        lexicons[r["kind"]][r["term"]] = r["odds"]
    return lexicons


def features_of(text: str | None, words: dict[str, float], stems: dict[str, float]) -> list[float]:
    """The features of a whole text; all are 0 for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    raw_words = text.split()
    tokens = [w.strip(_STRIP) for w in text.lower().split()]
    n = max(1, len(tokens))
    found = list(map(words.get, tokens))
    hits = [i for i, w in enumerate(found) if w is not None]
    weight = sum(found[i] for i in hits)
    short, long = STEMS
    stem_at = [i for i, t in enumerate(tokens) if t[:short] in stems or t[:long] in stems]
    mixed = [i for i, t in enumerate(tokens) if t and not t.isalpha() and any(map(str.isalpha, t))]
    disguised = [i for i in mixed if (p := plain(tokens[i])) in words or p and p[:long] in stems]
    persons = np.array([i for i, t in enumerate(tokens) if t in SECOND_PERSON])
    suspects = np.array(sorted({*hits, *stem_at, *disguised}))
    near = 0
    if len(persons) and len(suspects):
        place = np.searchsorted(persons, suspects)
        left = np.abs(suspects - persons[np.maximum(place - 1, 0)])
        right = np.abs(suspects - persons[np.minimum(place, len(persons) - 1)])
        near = int((np.minimum(left, right) <= NEAR).sum())
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bytes_of = np.bincount(raw, minlength=256)
    letters = max(1, int(bytes_of[_LETTER].sum()))
    marks = _MARK[raw]
    repeated = int((marks[1:] & (raw[1:] == raw[:-1])).sum())
    return [
        math.log1p(len(tokens)),
        math.log1p(len(hits)),
        len(hits) / n,
        weight / n,
        max((found[i] for i in hits), default=0.0),
        math.log1p(len(stem_at)),
        len(stem_at) / n,
        max((stems.get(tokens[i][:k], 0.0) for i in stem_at for k in STEMS), default=0.0),
        math.log1p(len(disguised)),
        len(persons) / n,
        math.log1p(near),
        float(bytes_of[_UPPER].sum()) / letters,
        sum(1 for w in raw_words if len(w) > 2 and w.isupper()) / n,
        float(bytes_of[_MARK].sum()) / len(raw),
        float(bytes_of[ord("!")]) / len(raw),
        repeated / len(raw),
        len(mixed) / n,
    ]


def _feature_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = shared.value
        for batch in batches:
            rows = [features_of(t.as_py(), lexicons["word"], lexicons["stem"]) for t in texts_of(batch)]
            matrix = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            columns = [batch.column("row"), *(pa.array(matrix[:, j]) for j in range(len(FEATURES)))]
            yield pa.RecordBatch.from_arrays(columns, ["row", *FEATURES])

    return run


def featured(documents: DataFrame, lexicons: dict, kept: list[str]) -> DataFrame:
    """`row` (a struct of the kept columns) and the features of the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(lexicons)
    rows = with_text(documents, kept)
    return rows.mapInArrow(
        _feature_batches(shared), with_columns(rows, **dict.fromkeys(FEATURES, T.DoubleType()))
    )


class ToxicityModel:
    """Lexicons, trees and calibration; without both classes a constant chance."""

    def __init__(self, lexicons, trees=None, calibration=None, constant=0.0):
        self.lexicons, self.trees, self.calibration = lexicons, trees, calibration
        self.constant = constant

    def score(self, documents: DataFrame, kept: list[str]) -> DataFrame:
        """`row` (a struct of the kept columns) and the chance that a document is toxic.

        The score is a function of the whole text alone.
        """
        if self.trees is None:
            rows = with_text(documents, kept)
            return rows.select("row", F.lit(float(self.constant)).alias("score"))
        margins = _with_margin(featured(documents, self.lexicons, kept), self.trees)
        fitted = self.calibration.transform(margins)
        # Between equal chances a slight slope keeps the order of the margins.
        chance = F.least(F.lit(1.0), F.greatest(F.lit(0.0), "calibrated"))
        slope = 1 / (1 + F.exp(-F.col("margin")))
        return fitted.select("row", (0.99 * chance + 0.01 * slope).alias("score"))


def _with_margin(rows: DataFrame, trees) -> DataFrame:
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    raw = trees.transform(assembled).withColumn("margin", vector_to_array("rawPrediction")[1])
    return raw.drop("features", "rawPrediction", "probability", "prediction", *FEATURES)


def labelled_sample(documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, text, y, part, weight) of up to so many learning rows per class, by a hash of the id.

    The weight is the number of labelled learning rows of the class over those taken.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    known = known.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD)
    known = known.withColumn("place", F.xxhash64("doc_id"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = [
        known.where(F.col("y") == y)
        .orderBy("place", "doc_id")
        .limit(per_class)
        .withColumn("weight", F.lit(max(1.0, sizes.get(y, 0) / per_class)))
        for y in (0, 1)
    ]
    # The ids of the sample are at most 2 * per_class.
    wanted = F.broadcast(ids[0].unionByName(ids[1]))
    rows = documents.select("doc_id", "text").join(wanted, "doc_id").dropDuplicates(["doc_id"])
    part = F.pmod("place", F.lit(CALIBRATION_SHARE))
    return checkpointed(rows.select("doc_id", "text", "y", part.alias("part"), "weight"))


def fit_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Learn from at most `per_class` labelled texts of each class, on the learning folds.

    The classes count by their shares among all labelled learning rows.
    """
    sample = labelled_sample(documents, labels, per_class)
    there = {tuple(r) for r in sample.select("y", F.col("part") > 0).distinct().collect()}
    classes, uses = {y for y, _ in there}, {learns for _, learns in there}
    if {y for y, learns in there if learns} != {0, 1} or False not in uses:
        return ToxicityModel({}, constant=1.0 if classes == {1} else 0.0)
    # Lexicons are learnt on other texts than the trees, which else would trust them too far.
    split = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    lexicons = learn_lexicons(sample.where("part > 0").where(split == 0))
    rows = checkpointed(featured(sample, lexicons, ["y", "part", "weight"]))
    # A few numbers per row by now: each of the many passes takes a task for so many rows.
    rows = rows.coalesce(math.ceil(2 * per_class / ROWS_PER_TASK))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        rows.where("row.part > 0").withColumn("label", F.col("row.y").cast("double"))
    )
    weights = assembled.select("features", "label", F.col("row.weight").alias("weight"))
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight"
    )
    trees = trees.fit(weights)
    margins = _with_margin(rows.where("row.part = 0"), trees)
    points = margins.select(
        "margin", F.col("row.y").cast("double").alias("label"), F.col("row.weight").alias("weight")
    )
    isotonic = IsotonicRegression(
        featuresCol="margin", labelCol="label", predictionCol="calibrated", weightCol="weight"
    )
    return ToxicityModel(lexicons, trees, isotonic.fit(points))


def classify_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Learns from labelled documents of four of five folds of the ids. A null
    text scores as an empty one. Labels that are null or neither 0 nor 1 are
    left out, and of several labels of a document the highest counts. With
    labels of one class only every text has that class, with none the score is
    0. Repeated rows have equal scores; rows without doc_id are scored too.
    """
    scored = fit_toxicity(documents, labels).score(documents, ["doc_id"])
    return scored.select(
        "row.doc_id",
        (fold(F.col("row.doc_id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
