"""Quality rules, line first.

Every line with a word is judged by itself. It fails when signs or exclamation marks stand beside
too many of its words (punctuation), when it has fewer than three words and no closing mark
(navigation), or when phrases of notices and licences, as whole words, make up a fair share of its words: one
in twelve at least (boilerplate). Failing lines go; a
text that loses over three fifths of its word characters is rejected, as is one that fails the base
rules: fewer than ten words, or over a fifth of its words in five-word windows that recur.

Defined cases: a null text has no words and is rejected; lines without a word are kept as they are.
Rows that repeat a doc_id each give a row. Extra columns are carried in ``row`` and not read. An empty
table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import BLANKS, whole_text

SIGNS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Tenths of a sign, or of an exclamation mark, a word.
MAX_SIGN_TENTHS = 3
NAVIGATION_WORDS = 3
CLOSING = ".!?:;,)\"'…"
PHRASES = [
    "all rights reserved", "licensed under", "released under", "copyright", "cookies?", "privacy policy", "terms of use", "terms of service",
    "lorem ipsum", "javascript", "subscribe", "sign up", "log in", "click here",
]
#: A phrase as whole words; the sign stands by itself.
BOILERPLATE = re.compile(rf"©|(?<![a-z0-9_])(?:{'|'.join(PHRASES)})(?![a-z0-9_])")
#: A line may have this many words for each phrase it holds.
WORDS_PER_PHRASE = 12
MAX_LOSS_PERCENT = 60
JUDGED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
          "n_failed_lines long, lost_chars long, clean_text string")


def repeated_words(words: list) -> int:
    """How many words lie in a five-word window that occurs twice or more."""
    if len(words) <= WINDOW:
        return 0
    ids: dict = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    size = len(words) - WINDOW + 1
    key, kinds = numbers[:size], len(ids)
    for place in range(1, WINDOW):
        if kinds * len(ids) >= 2**62:
            key = np.unique(key, return_inverse=True)[1]
            kinds = int(key.max()) + 1
        key = key * len(ids) + numbers[place:place + size]
        kinds *= len(ids)
    _, at, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[at] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, BLANKS))


def fails(line: str) -> bool:
    """Whether a line with a word fails a rule."""
    words = len(line.encode().split())
    signs = sum(map(line.count, SIGNS))
    if 10 * signs > MAX_SIGN_TENTHS * words or 10 * line.count("!") > MAX_SIGN_TENTHS * words:
        return True
    if words < NAVIGATION_WORDS and line.rstrip(BLANKS)[-1] not in CLOSING:
        return True
    return words <= WORDS_PER_PHRASE * sum(1 for _ in BOILERPLATE.finditer(line.lower()))


def judge(text: str) -> tuple:
    """The values of ``JUDGED`` for one text."""
    words = text.encode().split()  # of bytes: white space x20, x09-x0D only
    lines, seen, repeats, lost, failed, clean = text.split("\n"), set(), 0, 0, 0, []
    for line in lines:
        if not line.strip(BLANKS):
            clean.append(line)
            continue
        repeats += line in seen
        seen.add(line)
        if fails(line):
            failed += 1
            lost += word_chars(line)
        else:
            clean.append(line)
    chars = word_chars(text)
    again = repeated_words(words)
    base = len(words) < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * len(words)
    kept = not base and 100 * lost <= MAX_LOSS_PERCENT * chars
    return len(words), chars, sum(map(text.count, SIGNS)), repeats, again, base, kept, failed, lost, "\n".join(clean)


def judge_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, row, and the columns of ``JUDGED``) per row of ``docs``; ``row`` is the whole row."""
    names = [c.split()[0] for c in JUDGED.split(", ")]

    @F.pandas_udf(f"struct<{', '.join(c.replace(' ', ':') for c in JUDGED.split(', '))}>")
    def rules(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([judge(t) for t in batch], columns=names)

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), rules(whole_text()).alias("judged"))
    return judged.select("doc_id", "row", *[F.col(f"judged.{n}").alias(n) for n in names])
