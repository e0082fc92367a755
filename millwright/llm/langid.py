"""Language identification by words first, backing off to character n-grams.

A model holds, per language, the log of the relative frequency of its most frequent words and of its
most frequent character n-grams of each length up to ``ORDER``. A word of a text that some language
knows adds to every language its log frequency there, or ``PENALTY`` where the language lacks it. A word
that none knows is cut, blanks at its ends included, into n-grams of length ``ORDER``: where some language knows some of
them, the word adds the mean over the known ones; else shorter n-grams are tried, down to single characters;
a word with nothing known adds ``PENALTY`` to all. The language with the greatest sum is predicted.

Words are runs of letters and marks of the lower-cased text. The score is the probability of the
predicted language when all languages are as likely beforehand.

The model is fitted on at most ``SAMPLE`` distinct texts of each language (those with the least text
hashes), whose whole texts Spark counts. It holds at most ``ENTRIES`` words and as many n-grams of each length per
language, fewer for many languages, so that its table has at most ``CELLS`` numbers.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text where no
language could be learned; a text with nothing known, and any tie, goes to the language with most documents
learned from, then the first by name. Rows with a null doc_id, lang or text are not learned from. Copies of
a text under one language are learned from once, rows that repeat are each predicted. Whole texts
are read, a long one in pieces cut between words. Empty tables give empty results. Extra columns
are carried in ``row`` and not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import discard, packed, stored, whole_text

ORDER = 6
SAMPLE = 1000
ENTRIES = 20_000
CELLS = 20_000_000
LEAST_ENTRIES = 300
PENALTY = -16.0
#: Words met while predicting are remembered up to this number, and about this many letters.
REMEMBERED, REMEMBERED_LETTERS = 200_000, 10_000_000
PIECE = 2_000_000
UNKNOWN = "und"


@lru_cache(maxsize=3)
def word_pattern(limit: int) -> re.Pattern:
    """Runs of letters and marks below the code point ``limit``, from the categories of Unicode."""
    spans, start = [], None
    for code in range(limit + 1):
        inside = code < limit and unicodedata.category(chr(code))[0] in "LM"
        if inside and start is None:
            start = code
        if not inside and start is not None:
            spans.append(f"{re.escape(chr(start))}-{re.escape(chr(code - 1))}")
            start = None
    return re.compile(f"[{''.join(spans)}]+")


@lru_cache(maxsize=1)
def wide_pattern() -> re.Pattern:
    """As ``word_pattern`` of 16 bits, with every character beyond them: one range, where the letters there are hundreds."""
    return re.compile(word_pattern(0x10000).pattern[:-2] + "\U00010000-\U0010ffff]+")


def _cut(text: str) -> list[str]:
    """The runs of letters and marks of a lower-cased text that hold a letter."""
    if text.isascii():
        return re.findall("[a-z]+", text)
    try:
        text.encode("latin-1")
        return word_pattern(256).findall(text)
    except UnicodeEncodeError:
        found = wide_pattern().findall(text)
    if max(text) > "\uffff":
        found = [part for w in found for part in ([w] if max(w) <= "\uffff" else word_pattern(sys.maxunicode + 1).findall(w))]
    return [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text that hold a letter, in pieces of bounded size."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and unicodedata.category(text[end])[0] in "LM":
            end += 1
        yield _cut(text[start:end].lower())
        start = end


def grams(word: str, length: int) -> list[str]:
    """The n-grams of a word, with a blank at each end but for single characters."""
    padded = f" {word} " if length > 1 else word
    return [padded[i:i + length] for i in range(len(padded) - length + 1)]


@dataclass
class LanguageModel:
    """Log frequencies: rows of ``table`` by word, and by n-gram of each length; a column per language."""

    languages: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]
    table: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; remembers the sums of words that the model does not hold."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = len(model.table)
        self.table = np.vstack([model.table, np.zeros((REMEMBERED, len(model.languages)), np.float32)])
        self._forget()

    def _forget(self) -> None:
        self.rows, self.next, self.letters = dict(self.model.words), self.known, 0

    def _found(self, word: str) -> list[int]:
        """The rows of the longest n-grams of which some language knows some."""
        for length in range(ORDER, 0, -1):
            known = self.model.grams[length - 1]
            rows = [known[g] for g in grams(word, length) if g in known]
            if rows:
                return rows
        return []

    def _learn(self, words: list[str]) -> None:
        """Sums of new words, found together: the mean over each word's n-grams."""
        found = [self._found(w) for w in words]
        counts = np.array([len(rows) for rows in found])
        sums = np.full((len(words), self.table.shape[1]), PENALTY, np.float64)
        if counts.any():
            flat = self.model.table[[r for rows in found for r in rows]].astype(np.float64)
            full = counts > 0
            sums[full] = np.add.reduceat(flat, (np.cumsum(counts) - counts)[full], axis=0) / counts[full, None]
        self.table[self.next:self.next + len(words)] = sums
        self.rows.update(zip(words, range(self.next, self.next + len(words))))
        self.next += len(words)
        self.letters += sum(map(len, words))

    def sums(self, text: str) -> np.ndarray | None:
        """The sum over the words of a text for each language; None without a word."""
        total = None
        for words in words_of(text):
            for start in range(0, len(words), REMEMBERED):
                part = words[start:start + REMEMBERED]
                new = sorted(set(part).difference(self.rows))
                if self.next + len(new) > len(self.table) or self.letters > REMEMBERED_LETTERS:
                    self._forget()
                    new = sorted(set(part).difference(self.rows))
                if new:
                    self._learn(new)
                found = self.table[np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=np.float64)
                total = found if total is None else total + found
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        sums = self.sums(text) if text else None
        if sums is None or not self.model.languages:
            return UNKNOWN, 0.0
        best = int(np.argmax(sums))
        return self.model.languages[best], float(1 / np.exp(sums - sums[best]).sum())


def learned_from(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_words(docs: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """(lang, documents) of what may be learned from, and (lang, word, n) over the sampled whole texts."""
    known = (
        docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .where(learned_from(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", F.xxhash64("text").alias("text_hash"), "text")
    )
    kinds = known.groupBy("lang", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    languages = kinds.groupBy("lang").agg(F.sum("rows").alias("documents"))
    least = Window.partitionBy("lang").orderBy("text_hash")
    chosen = kinds.withColumn("place", F.row_number().over(least)).where(F.col("place") <= sample).select("lang", "text_hash")
    # at most ``sample`` rows of a name and a number per language
    texts = known.join(F.broadcast(chosen), ["lang", "text_hash"]).dropDuplicates(["lang", "text_hash"]).select("lang", "text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter((lang, w) for lang, text in zip(batch["lang"], batch["text"]) for part in words_of(text) for w in part)
            yield pd.DataFrame([(lang, w, n) for (lang, w), n in found.items()], columns=["lang", "word", "n"])

    return languages, texts.mapInPandas(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def entries_for(languages: int) -> int:
    """How many words, and n-grams of each length, a model holds per language."""
    return min(ENTRIES, max(LEAST_ENTRIES, CELLS // ((ORDER + 1) * max(languages, 1) ** 2)))


def _pieces(length: int) -> Column:
    """The n-grams of the column ``word``, as ``grams`` cuts them."""
    source = F.concat(F.lit(" "), "word", F.lit(" ")) if length > 1 else F.col("word")

    def piece(start: Column) -> Column:
        return F.substr(source, start, F.lit(length))

    places = F.when(F.length(source) >= length, F.sequence(F.lit(1), F.length(source) - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, piece)


def fit(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """The model of ``docs.lang`` over documents that are not held out."""
    spark = docs.sparkSession
    languages, words = sample_words(docs, sample)
    by_size = [r["lang"] for r in languages.orderBy(F.col("documents").desc(), "lang").collect()]  # one row per language
    kept, path = stored(words, "language-words")
    parts = [kept.select("lang", F.lit(0).alias("length"), F.col("word").alias("unit"), "n")]
    parts += [kept.select("lang", F.lit(k).alias("length"), F.explode(_pieces(k)).alias("unit"), "n") for k in range(1, ORDER + 1)]
    counts = reduce(DataFrame.union, parts).groupBy("lang", "length", "unit").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    most = Window.partitionBy("lang", "length").orderBy(F.col("n").desc(), "unit")
    top = counts.withColumn("place", F.row_number().over(most)).where(F.col("place") <= entries_for(len(by_size)))
    # at most entries_for * (ORDER + 1) rows per language
    entries = top.join(totals, ["lang", "length"]).select("lang", "length", "unit", F.log(F.col("n") / F.col("total")).alias("value")).toArrow()
    discard(spark, path)
    places: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
    lengths, units = entries["length"].to_pylist(), entries["unit"].to_pylist()
    number = 0
    for length, unit in zip(lengths, units):
        if unit not in places[length]:
            places[length][unit] = number
            number += 1
    table = np.full((number, len(by_size)), PENALTY, np.float32)
    at = np.array([places[length][unit] for length, unit in zip(lengths, units)], np.int64)
    table[at, entries["lang"].to_pandas().map({lang: j for j, lang in enumerate(by_size)}).to_numpy(np.int64)] = np.maximum(entries["value"].to_numpy(), PENALTY)
    return LanguageModel(by_size, places[0], places[1:], table)


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(row, doc_id, lang_pred, score) per row of ``docs``; ``row`` is the whole row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = shared.value.scorer()
        for batch in batches:
            yield pd.DataFrame([scorer.predict(t) for t in batch], columns=["lang_pred", "score"])

    found = packed(docs, doc_id=F.col("doc_id").cast("long"), found=predict(whole_text()))
    return found.select("row", "doc_id", "found.lang_pred", "found.score")
