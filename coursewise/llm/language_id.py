"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams inside words (a word is
padded with one blank on either side). A document's own most frequent n-grams are compared with
every profile by the out-of-place distance: the sum of rank differences, and the longest possible
difference for an n-gram the profile lacks. The nearest profile wins.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from coursewise.llm.common import held_out, map_texts

SIZES = (1, 2, 3)
PROFILE = 400
RUN = re.compile(r"[^\W\d_]+")
UNDECIDED = "und"
DOCUMENTS = 2000  # judged together


def letter_words(text: str) -> Counter:
    """Runs of letters in lower case, with their counts."""
    words = Counter(RUN.findall(text.lower()))
    for word in [w for w in words if not w.isalpha()]:  # runs that hold number-like characters
        times = words.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            words[part] += times
    return words


def grams_of(word: str) -> list[str]:
    padded = f" {word} "
    return [g for n in SIZES for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " "]


def gram_counts(words: Counter) -> dict[str, int]:
    counts: dict[str, int] = defaultdict(int)
    for word, times in words.items():
        for gram in grams_of(word):
            counts[gram] += times
    return counts


def profile_of(counts: dict[str, int], size: int = PROFILE) -> list[str]:
    """The most frequent n-grams, ties by code point."""
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def language_profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Rows (lang, gram, rank from 0) from all texts whose lang is known.

    N-grams are counted inside each batch before they are shuffled, and Spark keeps no more than
    ``size`` rows of a language per task before ranking.
    """

    def build(batch: pa.RecordBatch) -> dict:
        words: dict[str, Counter] = defaultdict(Counter)
        for at in range(0, batch.num_rows, DOCUMENTS):
            some = batch.slice(at, DOCUMENTS)
            for lang, text in zip(some.column("lang").to_pylist(), some.column("text").to_pylist(), strict=True):
                words[lang].update(letter_words(text))
        rows = [(lang, g, n) for lang in list(words) for g, n in gram_counts(words.pop(lang)).items()]
        langs, grams, times = zip(*rows, strict=True) if rows else ((), (), ())
        return {"lang": pa.array(langs, pa.string()), "gram": pa.array(grams, pa.string()), "times": pa.array(times, pa.int64())}

    known = docs.where("lang is not null and text is not null").select("lang", "text")
    counts = map_texts(known, "lang string, gram string, times long", build).groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("times"), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("rank"))


def predict_languages(docs: DataFrame, profiles: dict[str, dict[str, int]], size: int = PROFILE) -> DataFrame:
    """Rows (doc_id, lang_pred, score) for every document.

    The score is 1 minus the distance as a share of the largest one possible. Equal distances go
    to the first language by name. A text that is null or has no letter is ``und`` with score 0,
    and so is every text where there is no profile.

    The n-grams of some thousand documents are numbered by code point and each of their distinct
    words is taken apart once; a document's counts are then sums over its words' numbers.
    """
    langs = sorted(profiles)

    def judge(batch: list[str | None]) -> tuple[list[str], list[float]]:
        names: dict[str, int] = {}
        texts = [letter_words(t or "") for t in batch]
        words = [np.array([names.setdefault(w, len(names)) for w in c], np.int64) for c in texts]
        taken_apart = [grams_of(w) for w in names]
        grams = sorted({g for x in taken_apart for g in x})
        number = {g: i for i, g in enumerate(grams)}
        flat = np.array([number[g] for x in taken_apart for g in x], np.int64)
        lengths = np.array([len(x) for x in taken_apart], np.int64)
        starts = np.cumsum(lengths) - lengths
        ranks = np.array([[profiles[lang].get(g, -1) for g in grams] for lang in langs], np.int64).reshape(len(langs), -1)
        found, scores = [], []
        for counter, own_words in zip(texts, words, strict=True):
            if not len(own_words) or not langs:
                found.append(UNDECIDED)
                scores.append(0.0)
                continue
            n, times = lengths[own_words], np.fromiter(counter.values(), np.float64, len(counter))
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            counts = np.bincount(flat[np.repeat(starts[own_words], n) + within], np.repeat(times, n), len(grams))
            there = np.flatnonzero(counts)
            key = (counts[there] * len(grams)).astype(np.int64) + (len(grams) - 1 - there)  # ties by code point
            if len(there) > size:
                top = np.argpartition(-key, size - 1)[:size]
                there, key = there[top], key[top]
            own = there[np.argsort(-key)]
            r = ranks[:, own]
            far = np.where(r >= 0, np.abs(r - np.arange(len(own))), size).sum(1)
            best = int(far.argmin())
            found.append(langs[best])
            scores.append(1 - far[best] / (size * len(own)))
        return found, scores

    def build(batch: pa.RecordBatch) -> dict:
        found, scores = [], []
        for at in range(0, batch.num_rows, DOCUMENTS):
            some, theirs = judge(batch.column("text").slice(at, DOCUMENTS).to_pylist())
            found += some
            scores += theirs
        return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(found, pa.string()), "score": pa.array(scores, pa.float64())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), f"doc_id {kind}, lang_pred string, score double", build)


def fit_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, dict[str, int]]:
    """Profiles of all documents that are not held out: ``size`` rows for each language."""
    profiles: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, gram, rank in language_profiles(docs.where(~held_out(F.col("doc_id"))), size).toLocalIterator():
        profiles[lang][gram] = rank
    return dict(profiles)


def language_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Repeated rows are judged alike."""
    predicted = predict_languages(docs, fit_profiles(docs))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
