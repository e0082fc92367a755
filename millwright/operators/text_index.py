"""Text search through an inverted index written as sorted files.

The index has one row per term and text that holds it, with the term's share of the text's weight, and
one row per term with its counts and its largest share. Files are ranged by term and then by text, so a term
that most texts hold is spread over many files and a search reads the row groups of its own terms.

A search joins the rare half of each question's weight first. The k-th best sum so far is a bar: where
all terms left could not lift a new text over it, they are only looked up for the texts that can still reach it;
questions with a lower bar read all their lists at once, each text's sum complete in its task, and rank those that reach the bar.
Results are exact either way.

Scores are integers, so sums do not depend on their order. With n texts that hold a term, df of them this one, and
a text of ``size`` terms where texts have ``mean`` on average: idf = floor(1000 * ln(1 + (n - df + 0.5) / (df + 0.5))), and a term's share
of a text floor(2200000 * count / (count + 0.3 + 0.9 * (size / mean))). A text's score sums, over the terms of
the question with repeats, idf times share. Terms are runs of letters and digits in lower case. A text or question
without a term is not found or finds nothing; texts with score 0 are not found.

A few questions over texts without an index are answered by one scan with the same scores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.operators.evaluation import ranked_within
from millwright.session import remove, scratch_path, stage

KEY = ["doc_id", "chunk_id"]
#: Rows of a few numbers that may go to every task.
FEW_ROWS = 100_000


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda t: t != "")


def _idf(n: int, df: Column) -> Column:
    return F.floor(1000 * F.log(1 + (F.lit(n) - df + 0.5) / (df + 0.5))).cast("long")


def _share(count: Column, size: Column, mean: float) -> Column:
    return F.floor(F.lit(2200000.0) * count / (count + 0.3 + F.lit(0.9) * (size / F.lit(mean)))).cast("long")


def _sizes(texts: DataFrame) -> tuple[int, float]:
    """How many texts hold a term, and how many terms those hold on average."""
    n, total = texts.where("size > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return n, total / n if n else 1.0


def _few(rows: DataFrame) -> DataFrame:
    """A stored table, sent to every task only while it is small."""
    return F.broadcast(rows) if rows.limit(FEW_ROWS + 1).count() <= FEW_ROWS else rows


@dataclass
class TextIndex:
    """``postings`` (term, doc_id, chunk_id, share), ``terms`` (term, df, idf, top)."""

    postings: DataFrame
    terms: DataFrame

    @classmethod
    def build(cls, chunks: DataFrame, path: str | None = None) -> TextIndex:
        """The index of ``chunks`` (doc_id, chunk_id, chunk), written under ``path``."""
        spark = chunks.sparkSession
        place = path or scratch_path(spark, "text-index")
        # whole chunks are shuffled by their key, so that the many more rows of their terms need no shuffle to be counted
        held = chunks.repartition(*KEY).select(*KEY, terms(F.col("chunk")).alias("words")).select(*KEY, F.size("words").alias("size"), F.explode("words").alias("term"))
        held.groupBy(*KEY, "size", "term").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{place}/counts")
        counts = spark.read.parquet(f"{place}/counts")
        n, mean = _sizes(counts.select(*KEY, "size").distinct())
        shares = counts.select("term", *KEY, _share(F.col("n"), F.col("size"), mean).alias("share"))
        shares.repartitionByRange("term", *KEY).sortWithinPartitions("term", *KEY).write.parquet(f"{place}/postings")
        remove(spark, f"{place}/counts")
        listed = spark.read.parquet(f"{place}/postings").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("share").alias("top"))
        listed.select("term", "df", _idf(n, F.col("df")).alias("idf"), "top").sortWithinPartitions("term").write.parquet(f"{place}/terms")
        return cls.load(spark, place)

    @classmethod
    def load(cls, spark, path: str) -> TextIndex:
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"))

    def asked(self, questions: DataFrame, question_id: str = "query_id", text: str = "text") -> DataFrame:
        """(question, term, weight, bound, rest): each question's known terms, rare ones first; ``rest`` bounds what the later ones add."""
        words = questions.select(F.col(question_id).alias("question"), F.explode(terms(F.col(text))).alias("term"))
        counted = words.groupBy("question", "term").agg(F.count(F.lit(1)).alias("n")).join(self.terms, "term")
        weighed = counted.select("question", "term", "df", (F.col("n") * F.col("idf")).alias("weight"), (F.col("n") * F.col("idf") * F.col("top")).alias("bound")).where("bound > 0")
        later = Window.partitionBy("question").orderBy("df", "term").rowsBetween(1, Window.unboundedFollowing)
        whole = Window.partitionBy("question")
        rest = F.coalesce(F.sum("bound").over(later), F.lit(0))
        return weighed.withColumns({"rest": rest, "all": F.sum("bound").over(whole)})

    def _lists(self, wanted: DataFrame) -> DataFrame:
        """(question, doc_id, chunk_id, part) over whole lists of the ``wanted`` (question, term, weight).

        For a few wanted rows each posting is shuffled once, by its text, and not once for each question that asks for its
        term; the sums over a text then need no shuffle.
        """
        hits = self.postings.join(wanted, "term")
        if wanted.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
            asked = self.postings.join(F.broadcast(wanted.select("term").distinct()), "term", "left_semi")
            hits = asked.repartition(*KEY).join(F.broadcast(wanted), "term")
        return hits.groupBy("question", *KEY).agg(F.sum(F.col("weight") * F.col("share")).alias("part"))

    def search(self, questions: DataFrame, k: int = 3, question_id: str = "query_id", text: str = "text") -> DataFrame:
        """(question_id, doc_id, chunk_id, score, rank): the ``k`` best texts of each question, ties by key."""
        asked = stage(self.asked(questions, question_id, text), "asked-terms")
        first = (F.col("rest") + F.col("bound")) * 2 > F.col("all")
        near = stage(self._lists(asked.where(first).select("question", "term", "weight")), "first-parts")
        bars = ranked_within(near, ["question"], [F.col("part").desc(), *[F.col(c) for c in KEY]], k).where(F.col("rank") == k).select("question", F.col("part").alias("bar"))
        left = asked.where(~first).groupBy("question").agg(F.sum("bound").alias("left"))
        state = stage(asked.select("question").distinct().join(left, "question", "left").join(bars, "question", "left").select(
            "question", F.coalesce("left", F.lit(0)).alias("left"), F.coalesce("bar", F.lit(0)).alias("bar")), "bars")
        closed = state.where(F.col("left") < F.col("bar"))
        later = stage(asked.where(~first).select("question", "term", "weight"), "later-terms")
        few = stage(near.join(_few(closed), "question").where(F.col("part") + F.col("left") >= F.col("bar")).select("question", *KEY, "part"), "candidates")
        looked_up = self.postings.join(_few(few.select("question", *KEY).join(_few(later), "question")), ["term", *KEY]).select("question", *KEY, (F.col("weight") * F.col("share")).alias("part"))
        scores = few.union(looked_up).groupBy("question", *KEY).agg(F.sum("part").alias("score"))
        # the k-th best sum is no less than the bar, so a text whose whole sum is below it leaves no task and is not sorted
        open_ones = stage(state.where(F.col("left") >= F.col("bar")).select("question", "bar"), "open-questions")
        rest = stage(asked.join(_few(open_ones.select("question")), "question", "left_semi").select("question", "term", "weight"), "open-terms")
        if rest.limit(1).count():
            reached = self._lists(rest).join(_few(open_ones), "question").where(F.col("part") >= F.col("bar"))
            scores = scores.union(reached.select("question", *KEY, F.col("part").alias("score")))
        scores = scores.where("score > 0")
        ranked = ranked_within(scores, ["question"], [F.col("score").desc(), *[F.col(c) for c in KEY]], k)
        return ranked.select(F.col("question").alias(question_id), *KEY, "score", "rank")


def scan_search(chunks: DataFrame, questions: DataFrame, k: int = 3, question_id: str = "query_id", text: str = "text") -> DataFrame:
    """As ``TextIndex.search``, by one pass over ``chunks`` for a few ``questions``, whose terms go to every task."""
    words = questions.select(F.col(question_id).alias("question"), F.explode(terms(F.col(text))).alias("term"))
    asked = stage(words.groupBy("question", "term").agg(F.count(F.lit(1)).alias("times")), "asked-terms")
    wanted = sorted(r["term"] for r in asked.select("term").distinct().limit(FEW_ROWS + 1).collect())
    if len(wanted) > FEW_ROWS:
        return TextIndex.build(chunks).search(questions, k, question_id, text)
    known = F.array(*[F.lit(t) for t in wanted]) if wanted else F.array().cast("array<string>")
    held = chunks.select(*KEY, terms(F.col("chunk")).alias("words"))
    # of each text the number of its terms and those that a question has
    texts = stage(held.select(*KEY, F.size("words").alias("size"), F.filter("words", lambda t: F.array_contains(known, t)).alias("words")), "texts")
    n, mean = _sizes(texts)
    counts = texts.select(*KEY, "size", F.explode("words").alias("term")).groupBy(*KEY, "size", "term").agg(F.count(F.lit(1)).alias("n"))
    listed = stage(counts.select("term", *KEY, _share(F.col("n"), F.col("size"), mean).alias("share")), "shares")
    weights = listed.groupBy("term").agg(_idf(n, F.count(F.lit(1))).alias("idf"))
    weighed = stage(asked.join(weights, "term").select("question", "term", (F.col("times") * F.col("idf")).alias("weight")), "weights")
    scores = listed.join(_few(weighed), "term").groupBy("question", *KEY).agg(F.sum(F.col("weight") * F.col("share")).alias("score")).where("score > 0")
    ranked = ranked_within(scores, ["question"], [F.col("score").desc(), *[F.col(c) for c in KEY]], k)
    return ranked.select(F.col("question").alias(question_id), *KEY, "score", "rank")
