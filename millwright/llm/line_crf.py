"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line's score is linear in its own features and those of the lines beside it; a two by two table
scores the labels of neighbouring lines. Forward and backward sums give every line's probability of
being good, and their mean weighted by line length is the document's score.

The fit reads a documented, bounded sample: of each label at most ``SAMPLE`` documents, those whose
doc_id hashes least, of at most ``SAMPLE_LINES`` lines; every line inherits its document's label.
Only the sampled features reach the driver. Scoring reads every text whole.

Defined cases: a null text is empty; an empty text is one empty line and is scored like any other.
Labels that are null or contradict each other are not used. Where the sample lacks one of the two
labels, every score is the share of label 1 in it, 1 without any labels. Rows that repeat a doc_id
each get a score. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import packed, whole_text

SAMPLE = 2000
SAMPLE_LINES = 400
ROUNDS = 150
DECAY = 1e-3
THRESHOLD = 0.3
KINDS = NEWLINE, BLANK, LETTER, UPPER, DIGIT, SIGN, SHOUT, STOP, BAR, OTHER = range(10)
N_FEATURES = 13


def _kind_table() -> np.ndarray:
    """The kind of each code point below U+0250; those beyond count as letters."""
    def kind(c: str) -> int:
        if c == "\n":
            return NEWLINE
        if c in " \t\x0b\x0c\r":
            return BLANK
        if c == "|":
            return BAR
        if c == "!":
            return SHOUT
        if c in ".?":
            return STOP
        if c in "#*$%&<>":
            return SIGN
        if c.isdigit():
            return DIGIT
        if c.isupper():
            return UPPER
        return LETTER if c.isalpha() else OTHER
    return np.array([kind(chr(i)) for i in range(0x250)], np.int64)


_TABLE = _kind_table()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of the lines of a text."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = np.where(points < 0x250, _TABLE[np.minimum(points, 0x24F)], LETTER)
    lines = text.split("\n")
    n = len(lines)
    line = np.cumsum(kinds == NEWLINE)
    line[kinds == NEWLINE] -= 1
    counts = np.bincount(line * len(KINDS) + kinds, minlength=n * len(KINDS)).reshape(n, len(KINDS)).astype(float)
    counts[:, NEWLINE] = 0
    length = counts.sum(axis=1)
    whole = np.maximum(length, 1)
    said: set[tuple] = set()
    lines_said: set[str] = set()
    again, copied, ends, few = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i, body in enumerate(lines):
        words = body.split()
        if len(words) > 2:
            grams = list(zip(words, words[1:], words[2:]))
            fresh = set(grams) - said
            again[i] = 1 - len(fresh) / len(grams)
            said |= fresh
        few[i] = len(words) < 3
        if words:
            copied[i] = body in lines_said
            lines_said.add(body)
            ends[i] = words[-1][-1] in ".?!\"'"
    shares = counts[:, [UPPER, DIGIT, SIGN, SHOUT, BAR, OTHER, BLANK]] / whole[:, None]
    features = np.column_stack([np.log1p(length) / 5, shares, whole / (counts[:, BLANK] + 1) / 10, ends, again, copied, few])
    return features, length


def with_neighbours(features: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, marks of both ends, and one."""
    n = len(features)
    edge = np.zeros((1, features.shape[1]))
    first, last = np.zeros((n, 1)), np.zeros((n, 1))
    first[0] = last[-1] = 1
    return np.hstack([features, np.vstack([edge, features[:-1]]), np.vstack([features[1:], edge]), first, last, np.ones((n, 1))])


def groups(lengths: np.ndarray, most: int = 512, cells: int = 200_000) -> Iterator[np.ndarray]:
    """Indices of chains of alike lengths, few enough to be padded together."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < most and lengths[order[end]] * (end - at + 1) <= cells and lengths[order[end]] <= 1.3 * lengths[order[at]] + 2:
            end += 1
        yield order[at:end]
        at = end


def forward_backward(good: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals, pairs, log sums) of padded chains.

    ``good`` has each line's score (0 for the label bad), ``table`` the scores of label pairs, bad
    first. ``marginals`` are the probabilities of good, ``pairs`` each
    chain's expected counts of label pairs.
    """
    chains, steps = good.shape
    size = np.maximum(good, 0)
    emit = np.stack([np.exp(-size), np.exp(good - size)], axis=2)
    base = table.max()
    move = np.exp(table - base)
    ahead = np.empty((chains, steps, 2))
    scale = np.ones((chains, steps))
    for t in range(steps):
        now = emit[:, t] if t == 0 else emit[:, t] * (ahead[:, t - 1] @ move)
        scale[:, t] = now.sum(axis=1)
        ahead[:, t] = now / scale[:, t, None]
    live = np.arange(steps)[None, :] < lengths[:, None]
    back = np.ones((chains, steps, 2))
    pairs = np.zeros((chains, 2, 2))
    for t in range(steps - 2, -1, -1):
        inside = live[:, t + 1]
        onward = emit[:, t + 1] * back[:, t + 1] / scale[:, t + 1, None]
        back[:, t] = np.where(inside[:, None], onward @ move.T, 1.0)
        pairs += ahead[:, t, :, None] * onward[:, None, :] * move * inside[:, None, None]
    marginals = ahead * back
    sums = (np.where(live, np.log(scale) + size, 0)).sum(axis=1) + base * (lengths - 1)
    return marginals[:, :, 1] / marginals.sum(axis=2), pairs, sums


@dataclass
class LineModel:
    """A fitted field; ``constant`` stands in for a score where there was nothing to fit."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    table: np.ndarray
    constant: float | None = None

    def line_scores(self, features: np.ndarray) -> np.ndarray:
        return with_neighbours((features - self.mean) / self.spread) @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        """The length-weighted share of good in each text."""
        out = np.full(len(texts), self.constant if self.constant is not None else 0.0)
        if self.constant is not None:
            return out
        read = [line_features(t) for t in texts]
        lengths = np.array([len(f) for f, _ in read], np.int64)
        for group in groups(lengths):
            padded = np.zeros((len(group), lengths[group].max()))
            for row, i in enumerate(group):
                padded[row, :lengths[i]] = self.line_scores(read[i][0])
            marginals, _, _ = forward_backward(padded, lengths[group], self.table)
            for row, i in enumerate(group):
                out[i] = np.average(marginals[row, :lengths[i]], weights=np.maximum(read[i][1], 1))
        return np.clip(out, 0, 1)


def fit_lines(chains: list[np.ndarray], labels: np.ndarray, good: float = 0.5, rounds: int = ROUNDS) -> LineModel:
    """The field that makes each chain's label likely on all its lines, by Adam on the mean likelihood;
    chains with label 1 weigh ``good`` together, the others the rest."""
    width = chains[0].shape[1] if chains else N_FEATURES
    if len(set(labels.tolist())) < 2:
        return LineModel(np.zeros(width), np.ones(width), np.zeros(3 * width + 3), np.zeros((2, 2)), float(labels[0]) if len(labels) else 1.0)
    lines = np.vstack(chains)
    mean, spread = lines.mean(axis=0), lines.std(axis=0) + 1e-6
    inputs = [with_neighbours((c - mean) / spread) for c in chains]
    lengths = np.array([len(c) for c in chains])
    share = np.where(labels == 1, good / (labels == 1).sum(), (1 - good) / (labels == 0).sum())
    batches = []
    for group in groups(lengths, 256):
        x = np.zeros((len(group), lengths[group].max(), 3 * width + 3))
        for row, i in enumerate(group):
            x[row, :lengths[i]] = inputs[i]
        batches.append((x, lengths[group], labels[group], share[group]))
    theta = np.zeros(3 * width + 3 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        grad = DECAY * theta
        table = theta[-4:].reshape(2, 2)
        for x, size, label, weight in batches:
            scores = x @ theta[:-4]
            steps = np.arange(x.shape[1])[None, :] < size[:, None]
            # a chain's likelihood is a mean over its lines, so long chains weigh as much as short ones
            each = weight / size
            marginals, pairs, _ = forward_backward(scores, size, table)
            grad[:-4] -= np.einsum("ct,ctf->f", np.where(steps, (label[:, None] - marginals) * each[:, None], 0), x)
            seen = np.einsum("c,cv->v", each * (size - 1), np.eye(2)[label])
            grad[-4:] -= (np.diag(seen) - np.einsum("c,cij->ij", each, pairs)).reshape(-1)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        theta -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return LineModel(mean, spread, theta[:-4], theta[-4:].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineModel:
    """The model of ``labels.quality`` over documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where((F.col("quality") == F.col("most")) & ~held_out(F.col("doc_id"))).drop("most")
    )
    picked = [known.where(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for value in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # at most 2 * sample rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).join(chosen, "doc_id")
    short = texts.where(F.size(F.split("text", "\n", -1)) <= SAMPLE_LINES)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "features": [line_features(t)[0].astype("<f4").tobytes() for t in batch["text"]]})

    rows = short.mapInPandas(features, "doc_id long, quality int, features binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    good = known.agg(F.avg("quality").cast("double")).first()[0] or 0.5
    chains = [np.frombuffer(r["features"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in rows]
    return fit_lines(chains, np.array([r["quality"] for r in rows], np.int64), good)


def scored(docs: DataFrame, model: LineModel) -> DataFrame:
    """(row, doc_id, score) per row of ``docs``; ``row`` is the whole row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.score(batch.tolist()))

    return packed(docs, doc_id=F.col("doc_id").cast("long"), score=score(whole_text()))
