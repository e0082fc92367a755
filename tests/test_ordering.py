"""The block methods equal plain windows, whatever the block size, skew or partitioning."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millwright.plans import ordering as O
from millwright.plans.quantiles import quantiles, value_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """Two groups, one key holding a third of the rows, ids with gaps."""
    return spark.range(3000).select(
        (F.col("id") * 7 % 10007).alias("uid"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") * 13 % 40).cast("int")).alias("key"),
        (F.col("id") * 31 % 997).alias("v"),
    )


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    columns = sorted(left.columns)
    assert sorted(map(tuple, left.select(columns).collect())) == sorted(map(tuple, right.select(columns).collect()))


@pytest.mark.parametrize("rows", [4, 300, 200_000])
@pytest.mark.parametrize("partitions", [1, 37])
def test_positions(skewed, rows, partitions):
    plain = skewed.withColumn("_pos", F.row_number().over(Window.partitionBy("g").orderBy("key", "uid")).cast("long"))
    plain = plain.withColumn("_total", F.count(F.lit(1)).over(Window.partitionBy("g")))
    same(O.positions(skewed.repartition(partitions), ["g"], "key", "uid", rows=rows), plain)


@pytest.mark.parametrize("rows", [4, 300, 200_000])
def test_dense_index(skewed, rows):
    plain = skewed.withColumn("n", F.row_number().over(Window.orderBy("uid")).cast("long"))
    same(O.dense_index(skewed, "uid", ["key"], "n", rows), plain)


def test_ntile(skewed):
    for buckets in (3, 4, 7):
        placed = O.positions(skewed, ["g"], "key", "uid", rows=64)
        ours = placed.select("uid", O.ntile(F.col("_pos"), F.col("_total"), buckets).alias("t"))
        same(ours, skewed.select("uid", F.ntile(buckets).over(Window.partitionBy("g").orderBy("key", "uid")).alias("t")))


def test_ntile_with_fewer_rows_than_buckets(spark):
    few = spark.createDataFrame([(1, 2), (2, 2)], "p long, t long")
    assert [r[0] for r in few.select(O.ntile(F.col("p"), F.col("t"), 4)).collect()] == [1, 2]


@pytest.mark.parametrize("descending", [False, True])
def test_value_ranks(skewed, descending):
    order = F.col("key").desc() if descending else F.col("key").asc()
    w = Window.partitionBy("g").orderBy(order)
    plain = skewed.select("uid", F.rank().over(w).alias("r"), F.percent_rank().over(w).alias("p"))
    ranks = O.value_ranks(skewed, ["g"], "key", descending)
    ours = skewed.join(ranks, ["g", "key"]).select(
        "uid", (F.col("rows_before") + 1).cast("int").alias("r"),
        O.percent_rank(F.col("rows_before"), F.col("rows_total")).alias("p"))
    same(ours, plain)


def test_sparse_ids_make_even_blocks(spark):
    """Ids spread over all of 64 bits, as a hash gives them, fall into blocks of the size asked for."""
    hashed = spark.range(20_000).select(F.xxhash64("id").alias("uid"))
    sizes = [r["count"] for r in O.id_blocks(hashed, "uid", 1000).groupBy("_block").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1200
    plain = hashed.withColumn("n", F.row_number().over(Window.orderBy("uid")).cast("long"))
    same(O.dense_index(hashed, "uid", [], "n", 1000), plain)


@pytest.mark.parametrize("rows", [10, 200_000])
@pytest.mark.parametrize("bounded", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_cumulate(skewed, by, bounded, rows):
    counts = skewed.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("s"))
    w = Window.partitionBy(*by).orderBy("v")
    plain = counts.withColumns({"cum_n": F.sum("n").over(w), "cum_s": F.sum("s").over(w)})
    same(O.cumulate(counts, by, "v", ["n", "s"], bounded, rows), plain)


def test_cumulate_single_value(spark):
    one = spark.createDataFrame([(5.0, 3)], "v double, n long")
    assert [tuple(r) for r in O.cumulate(one, [], "v", ["n"]).collect()] == [(5.0, 3, 3)]


@pytest.mark.parametrize("bits", [5, 8])
def test_trailing_frames(skewed, bits):
    placed = O.positions(skewed, ["g"], "key", "uid").drop("_total")
    frame = Window.partitionBy("g").orderBy("_pos").rowsBetween(-20, 0)
    plain = placed.withColumn("m", F.sum("v").over(frame))
    same(O.trailing_frames(placed, ["g"], "_pos", 20, {"m": lambda f: F.sum("v").over(f)}, bits), plain)


def test_trailing_frame_must_fit_a_block(skewed):
    with pytest.raises(ValueError):
        O.trailing_frames(skewed, ["g"], "uid", 20, {}, 4)


@pytest.mark.parametrize("rows", [8, 200_000])
def test_sequence_by_key(skewed, rows):
    w = Window.partitionBy("key").orderBy("uid")
    plain = skewed.withColumns({"n": F.row_number().over(w).cast("long"), "p": F.lag("v").over(w)})
    ours = O.sequence_by_key(skewed, "key", "uid", "v", "n", "p", rows)
    columns = sorted(plain.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, ours.select(columns).collect()), key=key) == sorted(
        map(tuple, plain.select(columns).collect()), key=key)


@pytest.mark.parametrize("bounded", [False, True])
def test_quantiles(spark, bounded):
    import numpy as np

    values = [float(x) for x in np.random.default_rng(1).normal(size=501).round(2)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = quantiles(value_counts(df, ["x"]), ["feature"], {"a": 0.1, "b": 0.5, "c": 0.93}, bounded).first()
    assert [row["a"], row["b"], row["c"]] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.93])))
    assert row["count"] == 501
