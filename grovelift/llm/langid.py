"""Language identification by words, backing off to ever shorter n-grams.

A word that the model knows scores with its log relative frequency in each
language, or a fixed penalty where that language lacks it. An unknown word
scores with the mean of its character n-grams of the greatest length of which
any is known, down to single characters. A text scores with the mean over its
words.

Word and n-gram counts cover all learning documents: partial counts are made
per task and added up by a grouped sum. Each language has the same share of the
words and n-grams that the model keeps, its most frequent ones, and what some
languages leave of theirs goes to the others. All single characters are kept, so
the words of any learnt script score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.llm.common import checkpointed, fold, released, texts_of, with_columns, with_text

MODEL_WORDS = 50_000
MODEL_NGRAMS = 50_000
NGRAM = 4
PENALTY = -7.0
UNDETERMINED = "und"
HELD_OUT_FOLD, FOLDS = 1, 3
# Distinct (language, word) pairs that a task holds before it passes counts on.
_HELD_COUNTS = 150_000
_CACHED_WORDS = 50_000
_BUCKETS = 64
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower())


def ngrams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked, as often as they occur."""
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _count_batch(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs, terms, numbers = [], [], []
    for lang, held in counts.items():
        langs += [lang] * len(held)
        terms += held.keys()
        numbers += held.values()
    columns = [pa.array(langs, pa.string()), pa.array(terms, pa.string()), pa.array(numbers, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            counts[lang.as_py()].update(words_of(text.as_py()))
            if sum(map(len, counts.values())) > _HELD_COUNTS:
                yield _count_batch(counts)
                counts.clear()
    yield _count_batch(counts)


def _count_ngrams(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "term", "n"))
            for lang, word, times in zip(*columns, strict=True):
                held = counts[lang]
                for n in range(1, longest + 1):
                    for gram in ngrams_of(word, n):
                        held[gram] += times
            if sum(map(len, counts.values())) > _HELD_COUNTS:
                yield _count_batch(counts)
                counts.clear()
        yield _count_batch(counts)

    return run


def _share(sizes: list[int], number: int) -> int:
    """The greatest share for which no more than `number` terms are taken, 1 at least."""
    left, share = number, number
    for i, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - i)
        if size > share:
            break
        left -= size
    return max(1, share)


def _most_frequent(counts: DataFrame, number: int) -> dict[str, dict[str, int]]:
    """The most frequent terms of each language, each with its count in all languages.

    A histogram per language over steps of about one percent gives the step at
    which its share ends. Terms above it are kept, and within it those with the
    highest counts, then the first in order.
    """
    spark = counts.sparkSession
    stepped = counts.withColumn("step", F.floor(F.log2("n") * 64).cast("int"))
    steps = stepped.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("terms")).collect()
    by_lang: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for r in steps:
        by_lang[r["lang"]].append((r["step"], r["terms"]))
    if not by_lang:
        return {}
    share = _share([sum(n for _, n in held) for held in by_lang.values()], number)
    ends = []  # of each language the last step and how many of its terms are taken
    for lang, held in by_lang.items():
        room = share
        for last, n in sorted(held, reverse=True):
            taken = min(n, room)
            room -= taken
            if not room:
                break
        ends.append((lang, last, taken))
    # One row per language.
    ends = F.broadcast(spark.createDataFrame(ends, "lang string, last int, taken int"))
    stepped = stepped.join(ends, "lang").where("step >= last")
    # The first of each bucket, then of the buckets, so that no task gets a whole step.
    order = [F.desc("n"), F.col("term")]
    bucket = F.pmod(F.xxhash64("term"), F.lit(_BUCKETS))
    tied = stepped.where("step = last").withColumn("bucket", bucket)
    for keys in (["lang", "bucket"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        tied = tied.withColumn("place", place).where("place <= taken")
    chosen = stepped.where("step > last").select("term").unionByName(tied.select("term"))
    # At most `number` terms, or one per language.
    return _all_terms(counts.join(F.broadcast(chosen.distinct()), "term", "left_semi"))


def _all_terms(counts: DataFrame) -> dict[str, dict[str, int]]:
    by = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    rows = counts.groupBy("term").agg(by.alias("by")).collect()
    return {r["term"]: r["by"] for r in sorted(rows, key=lambda r: r["term"])}


def _scores(terms: dict[str, dict[str, int]], langs: list[str], totals: list[int]) -> np.ndarray:
    out = np.full((len(terms), len(langs)), PENALTY, np.float32)
    place = {lang: i for i, lang in enumerate(langs)}
    for row, by in enumerate(terms.values()):
        for lang, n in by.items():
            if lang in place:
                i = place[lang]
                out[row, i] = max(PENALTY, math.log10(n / totals[i]))
    return out


class LanguageModel:
    """Scores of words and n-grams per language, made of `parts` that tasks can be sent."""

    def __init__(self, langs, usual, words, word_scores, grams, gram_scores, longest):
        self.parts = (langs, usual, words, word_scores, grams, gram_scores, longest)
        self.langs, self.usual, self.longest = langs, usual, longest
        self.words = {w: i for i, w in enumerate(words)}
        self.grams = {g: i for i, g in enumerate(grams)}
        self.word_scores, self.gram_scores = word_scores, gram_scores
        # Unknown words seen lately: their row of scores, or None if nothing of them is known.
        self.seen: dict[str, int | None] = {}
        self.seen_scores = np.zeros((_CACHED_WORDS, max(1, len(langs))), np.float32)

    def unknown_word(self, word: str) -> np.ndarray | None:
        """The mean score of the longest known n-grams; None if no character is known."""
        for n in range(self.longest, 0, -1):
            found = [i for i in map(self.grams.get, ngrams_of(word, n)) if i is not None]
            if found and (n > 1 or any(c in self.grams for c in word)):
                return self.gram_scores[found].mean(axis=0)
        return None

    def _unknown_rows(self, words: list[str]) -> list[int]:
        if len(self.seen) + len(words) > _CACHED_WORDS:
            self.seen.clear()
        fresh = {w for w in words if w not in self.seen}
        if len(fresh) > _CACHED_WORDS:  # a text with more unknown words than fit
            self.seen_scores = np.zeros((len(fresh), len(self.langs)), np.float32)
        for word in fresh:
            scores = self.unknown_word(word)
            at = len(self.seen)
            self.seen[word] = None if scores is None else at
            if scores is not None:
                self.seen_scores[at] = scores
        return [i for i in map(self.seen.get, words) if i is not None]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and, from 0 to 1, how far its mean word is likelier there.

        Of words without any known character nothing can be said: they get the
        language with most words, with score 0.
        """
        words = words_of(text) if text else []
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        found = list(map(self.words.get, words))
        known = [i for i in found if i is not None]
        total = self.word_scores[known].sum(axis=0, dtype=np.float64)
        n = len(known)
        if n < len(words):
            rows = self._unknown_rows([w for w, i in zip(words, found, strict=True) if i is None])
            total += self.seen_scores[rows].sum(axis=0, dtype=np.float64)
            n += len(rows)
        if not n:
            return self.usual, 0.0
        mean = total / n * math.log(10)
        chances = np.exp(mean - mean.max())
        best = int(np.argmax(mean))
        return self.langs[best], float(chances[best] / chances.sum())


def fit_languages(
    documents: DataFrame,
    model_words: int = MODEL_WORDS,
    model_ngrams: int = MODEL_NGRAMS,
    longest: int = NGRAM,
) -> LanguageModel:
    """Learn from text and lang of all given documents that have both.

    The model holds at most so many words and n-grams, an equal share per
    language, besides all single characters. All languages are held.
    """
    given = documents.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    schema = "lang string, term string, n long"
    summed = given.mapInArrow(_count_words, schema).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    words = checkpointed(summed)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    sizes = {r["lang"]: r["n"] for r in sizes.collect()}
    langs = sorted(sizes)
    grams = words.mapInArrow(_count_ngrams(longest), schema)
    grams = checkpointed(grams.groupBy("lang", "term").agg(F.sum("n").alias("n")))
    lengths = grams.groupBy("lang", F.char_length("term").alias("length")).agg(F.sum("n").alias("n"))
    gram_sizes = {(r["lang"], r["length"]): r["n"] for r in lengths.collect()}
    top_words = _most_frequent(words, model_words)
    single = F.char_length("term") == 1
    top_grams = _all_terms(grams.where(single)) | _most_frequent(grams.where(~single), model_ngrams)
    word_scores = _scores(top_words, langs, [sizes[x] for x in langs])
    gram_scores = np.zeros((len(top_grams), len(langs)), np.float32)
    kinds = np.array([len(g) for g in top_grams])
    for n in range(1, longest + 1):
        some = {g: by for g, by in top_grams.items() if len(g) == n}
        gram_scores[kinds == n] = _scores(some, langs, [gram_sizes.get((x, n), 1) for x in langs])
    usual = max(langs, key=lambda x: (sizes[x], x), default=UNDETERMINED)
    return LanguageModel(
        langs, usual, list(top_words), word_scores, list(top_grams), gram_scores, longest
    )


def _predict_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*shared.value)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in texts_of(batch)]
            names = pa.array([f[0] for f in found], pa.string())
            scores = pa.array([f[1] for f in found], pa.float64())
            columns = [batch.column("row"), names, scores]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score"])

    return run


def predict_languages(documents: DataFrame, model: LanguageModel, kept: list[str]) -> DataFrame:
    """`row` (a struct of the kept columns), lang_pred and score, from the whole text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model.parts)
    rows = with_text(documents, kept)
    schema = with_columns(rows, lang_pred=T.StringType(), score=T.DoubleType())
    predict = _predict_batches(shared)
    return rows.mapInArrow(lambda batches: released(predict(batches)), schema)


def fit_on_folds(documents: DataFrame) -> LanguageModel:
    """Learn from the two of three folds of the ids that are not held out."""
    return fit_languages(documents.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD))


def identify_languages(documents: DataFrame) -> DataFrame:
    """Learn on two of three folds of the ids, predict for all rows.

    Rows with a null text or lang are not learnt from. A text that is null or
    has no letter is `und` with score 0, and so is every text if nothing could
    be learnt. A text none of whose characters was ever seen gets the language
    with most words learnt, with score 0. Equally likely languages
    are taken in alphabetical order. A row without doc_id is learnt from and
    predicted like others; repeated rows count as often as they occur.
    """
    predicted = predict_languages(documents, fit_on_folds(documents), ["doc_id"])
    held_out = fold(F.col("row.doc_id"), FOLDS) == HELD_OUT_FOLD
    return predicted.select("row.doc_id", held_out.alias("held_out"), "lang_pred", "score")
