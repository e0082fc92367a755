"""Seeded stratified splits with exact stratum counts and no shuffle of the rows.

Rows are ordered by a hash of their id inside each stratum and cut at the wanted counts. Only the
cut points are computed: hash-prefix counts locate the bucket a cut falls in, and the rows of those
few buckets are ranked. Assigning a row is then a comparison with literals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import stage


PREFIX = 4  # hex digits of the hash that name a bucket: 65,536 buckets


def row_hash(uid: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(uid).cast("string"), F.lit(f"|{seed}")))


def _deal(sizes: DataFrame, stratum: str, count: str, held_pct: int, name: str) -> DataFrame:
    """Share all rows but the rounded-up ``held_pct`` among strata in proportion to ``count``.

    Leftover rows go to the largest remainders. There is one input row per stratum.
    """
    totals = sizes.selectExpr("*", f"sum({count}) OVER () AS _all")
    wanted = totals.selectExpr("*", f"_all - CAST(ceil(_all * {held_pct} / 100) AS BIGINT) AS _want")
    shares = wanted.selectExpr("*", f"(_want * {count}) div _all AS _base", f"(_want * {count}) % _all AS _rest")
    ranked = shares.selectExpr(
        "*", "_want - sum(_base) OVER () AS _left", f"row_number() OVER (ORDER BY _rest DESC, `{stratum}`) AS _place")
    return ranked.selectExpr(*sizes.columns, f"_base + IF(_place <= _left, 1, 0) AS {name}")


def stratum_cuts(sizes: DataFrame, stratum: str, held_out_pct: int, second_pct: int) -> DataFrame:
    """Rows per stratum that end up before the first and the second cut.

    The held-out share is rounded up over all rows and dealt to strata in proportion; its second
    part is rounded up likewise.
    """
    first = _deal(sizes, stratum, "n", held_out_pct, "first_cut").selectExpr("*", "n - first_cut AS _held")
    both = _deal(first, stratum, "_held", second_pct, "_middle")
    return both.selectExpr(f"`{stratum}`", "n", "first_cut", "first_cut + _middle AS second_cut")


def stratified_split(df: DataFrame, uid: str, stratum: str, seed: int, held_out_pct: int = 30,
                     second_pct: int = 50, names: tuple[str, str, str] = ("train", "val", "test")) -> DataFrame:
    """Adds ``split``. With ``second_pct=100`` the held-out part is not divided and is all ``names[2]``.

    ``stratum`` must have a small domain (a binary target, a failure mode).
    """
    def wanted(sizes: DataFrame) -> DataFrame:
        return stratum_cuts(sizes, stratum, held_out_pct, second_pct).select(stratum, F.array("first_cut", "second_cut").alias("cuts"))

    def part(cuts: list) -> Column:
        return F.when(_before(uid, seed, cuts[0]), names[0]).when(_before(uid, seed, cuts[1]), names[1]).otherwise(names[2])

    # two cut points for each of the few strata come to the driver: from here on the split is a plain expression
    split = F.lit(names[2])
    for value, cuts in cut_points(df, uid, stratum, seed, wanted, 2).items():
        split = F.when(F.col(stratum) == F.lit(value), part(cuts)).otherwise(split)
    return df.withColumn("split", split)


def _before(uid: str, seed: int, cut: tuple[str, int] | None) -> Column:
    """Whether a row comes at or before a cut point."""
    if cut is None:
        return F.lit(False)
    mine = row_hash(uid, seed)
    return (mine < cut[0]) | (mine == cut[0]) & (F.col(uid).cast("long") <= cut[1])


def cut_points(df: DataFrame, uid: str, stratum: str, seed: int, wanted: Callable[[DataFrame], DataFrame], n_cuts: int) -> dict:
    """Per stratum the (hash, id) of the last row before each of ``n_cuts`` cuts, None for a cut before all rows.

    ``wanted`` gives (stratum, array ``cuts`` of row counts) from (stratum, n).
    """
    hashed = df.select(F.col(stratum), F.col(uid).cast("long").alias("_uid"), row_hash(uid, seed).alias("_hash"))
    bucketed = hashed.withColumn("_bucket", F.substring("_hash", 1, PREFIX))
    # at most 65,536 rows per stratum, written once, as four steps read them
    counts = stage(bucketed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n")), "split-counts")
    sizes = counts.groupBy(stratum).agg(F.sum("_n").alias("n"))
    asked = wanted(sizes).select(stratum, F.posexplode("cuts").alias("which", "rows"))

    ordered = Window.partitionBy(stratum).orderBy("_bucket")  # at most 65,536 rows per stratum
    spans = counts.withColumn("_end", F.sum("_n").over(ordered)).withColumn("_start", F.col("_end") - F.col("_n"))
    hit = spans.join(asked, stratum).where(
        (F.col("rows") > F.col("_start")) & (F.col("rows") <= F.col("_end"))
    ).select(stratum, "_bucket", "which", (F.col("rows") - F.col("_start")).alias("_nth"))

    # The rows that share a bucket with a cut: ``n_cuts`` buckets per stratum.
    near = bucketed.join(F.broadcast(hit), [stratum, "_bucket"])  # n_cuts rows per stratum
    rank = F.row_number().over(Window.partitionBy(stratum, "which").orderBy("_hash", "_uid"))
    found: dict = {row[stratum]: [None] * n_cuts for row in sizes.select(stratum).collect()}
    for row in near.withColumn("_rank", rank).where(F.col("_rank") == F.col("_nth")).select(stratum, "which", "_hash", "_uid").collect():
        found[row[stratum]][row["which"]] = (row["_hash"], row["_uid"])
    return found


def folds(df: DataFrame, uid: str, stratum: str, seed: int, k: int) -> DataFrame:
    """Adds ``fold`` 0..k-1: each stratum, in hash order, is cut at k-ths of its rows, so its folds differ by one row at most."""
    def wanted(sizes: DataFrame) -> DataFrame:
        return sizes.select(stratum, F.array(*[F.expr(f"n * {i} div {k}") for i in range(1, k)]).alias("cuts"))

    fold = F.lit(k - 1)
    for value, cuts in cut_points(df, uid, stratum, seed, wanted, k - 1).items():
        place = F.lit(k - 1)
        for i in range(k - 2, -1, -1):
            place = F.when(_before(uid, seed, cuts[i]), i).otherwise(place)
        fold = F.when(F.col(stratum).eqNullSafe(F.lit(value)), place).otherwise(fold)
    return df.withColumn("fold", fold)


def sample_rows(df: DataFrame, uid: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in hash order: the same rows on every run and any partitioning."""
    return df.withColumn("_hash", row_hash(uid, seed)).orderBy("_hash", uid).limit(n).drop("_hash")
