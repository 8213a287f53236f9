"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is its lower-cased letters, any other run of characters counting as one blank. Training
counts the n-grams of every language, one row for each language and bin leaving a task; the
matrix of log probabilities is small (languages by bins) and goes to every task that scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.grams import BASE, RUN_CHARS, U64, code_points, letter_characters, mix
from quotelake.llm.shared import text_runs

COUNT_SCHEMA = "lang string, bin int, n bigint"
UNDETERMINED = "und"


@dataclass(frozen=True)
class Features:
    """Which n-grams are counted, and into how many bins (a power of two) they are hashed."""

    orders: tuple[int, ...] = (1, 2, 3)
    bins: int = 1 << 14

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The bins of all n-grams, in order of the texts, and where each text's begin."""
        codes, starts = code_points(texts)
        letters = letter_characters()[codes]
        # Of a run of other characters only the one before the next word stays, as a blank.
        keep = letters | np.append(letters[1:], False)
        keep[starts[1:] - 1] = False
        kept = np.concatenate([[0], np.cumsum(keep)])[starts]
        plain = np.where(letters, codes, np.uint32(32))[keep].astype(U64)
        at, stop = np.arange(len(plain)), np.repeat(kept[1:], np.diff(kept))
        found, rolled = [], np.zeros(len(plain), U64)
        for n in range(1, max(self.orders) + 1):
            ahead = at + (n - 1)
            # Past the end of its text an n-gram holds blanks.
            follows = np.where(ahead < stop, plain[np.minimum(ahead, len(plain) - 1)], U64(32)) if len(plain) else plain
            rolled = mix(rolled + (follows + U64(1)) * U64(BASE))
            if n in self.orders:
                found.append((rolled & U64(self.bins - 1)).astype(np.int32))
        return np.stack(found, 1).ravel(), kept * len(self.orders)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_likelihood: np.ndarray  # bins by languages
    features: Features
    usual: np.ndarray  # the mean log likelihood of an n-gram of the labelled texts, by language
    spread: np.ndarray  # its standard deviation

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The most probable language of each text, and its posterior probability."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The most probable language of each text, its posterior probability, and how far the text is
        from it: by how much its mean log likelihood of an n-gram is below the usual one of the
        language, less two standard errors for as many letters."""
        bins, starts = self.features.of(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        filled = np.flatnonzero(np.diff(starts))
        for j in range(len(self.languages)):
            if len(filled):
                sums[filled, j] = np.add.reduceat(self.log_likelihood[:, j][bins], starts[:-1][filled], dtype=np.float64)
        sums += self.log_prior
        best = sums.argmax(1)
        n = np.maximum(np.diff(starts), 1)
        mean = (sums[np.arange(len(texts)), best] - self.log_prior[best]) / n
        distance = self.usual[best] - mean - 2 * self.spread[best] / np.sqrt(n / len(self.features.orders))
        return best, 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1), distance


def count_ngrams(labelled: DataFrame, features: Features) -> DataFrame:
    """`lang, bin, n` over all rows of `labelled` (`lang, text`)."""

    def run(batches: Iterator[pa.RecordBatch]):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for own in text_runs(texts, RUN_CHARS):
                bins, starts = features.of(texts[own])
                codes = {lang: i for i, lang in enumerate(dict.fromkeys(langs[own]))}
                row = np.repeat(np.array([codes[x] for x in langs[own]]), np.diff(starts))
                table = np.bincount(row * features.bins + bins, minlength=len(codes) * features.bins)
                for lang, i in codes.items():
                    counts.setdefault(lang, np.zeros(features.bins, np.int64))
                    counts[lang] += table[i * features.bins : (i + 1) * features.bins]
        for lang, table in counts.items():
            at = np.flatnonzero(table)
            yield pa.record_batch(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at])],
                ["lang", "bin", "n"],
            )

    return labelled.select("lang", "text").mapInArrow(run, COUNT_SCHEMA).groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, features: Features = Features(), most_languages: int = 1000) -> LanguageModel | None:
    """The model of all rows with a text and a language; None if there are none.

    What reaches the driver is one number for each language and bin. More than `most_languages`
    labels mean that the column holds no languages, and end the job.
    """
    labelled = labelled.where("text is not null and lang is not null")
    # Each document weighs as its number of n-grams, a language as its number of documents.
    documents = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).take(most_languages + 1)}
    if len(documents) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not documents:
        return None
    languages = tuple(sorted(documents))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.ones((features.bins, len(languages)))
    for lang, at, n in count_ngrams(labelled, features).toLocalIterator():
        counts[at, place[lang]] += n
    prior = np.array([documents[lang] for lang in languages], float)
    likelihood = np.log(counts / counts.sum(0))
    # What was seen itself, without the one that is added to each bin.
    seen = (counts - 1) / np.maximum((counts - 1).sum(0), 1)
    usual = (seen * likelihood).sum(0)
    spread = np.sqrt((seen * (likelihood - usual) ** 2).sum(0))
    return LanguageModel(languages, np.log(prior / prior.sum()), likelihood.astype(np.float32), features, usual, spread)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel | None) -> Column:
    """A column for `docs`: struct `lang, score, distance` of the language of `text`, from the whole text alone.

    `und` with score 0 if the text is null or has no letter, or if nothing was learned. Of languages
    that are equally probable the first by name is taken. The score compares the learned languages
    with each other only; `distance` tells whether the text is of any of them (see `judge`).
    """
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("distance"))
    if model is None:
        return unknown
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, distance double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts, best = batch.tolist(), np.zeros(len(batch), int)
            score, distance = np.zeros(len(batch)), np.zeros(len(batch))
            for own in text_runs(texts, RUN_CHARS):
                best[own], score[own], distance[own] = model.judge(texts[own])
            yield pd.DataFrame({"lang": np.array(model.languages, object)[best], "score": score, "distance": distance})

    # So that a filter on the result does not run the model a second time.
    return F.when(has_letters(docs["text"]), predict.asNondeterministic()(docs["text"])).otherwise(unknown)
