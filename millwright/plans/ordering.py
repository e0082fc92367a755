"""Exact ordered results over few, huge or skewed groups.

A window partitioned by machine type keeps three tasks busy however large the cluster is, and one
over all rows keeps one. The shapes here cut an ordering into blocks whose size is bounded by
construction, order the rows inside each block, and carry the block totals:

* blocks of a unique id, and of distinct values, lie between approximate quantiles of these, so
  sparse and hashed ids make blocks as even as dense ones;
* their number follows the count of rows, about ``BLOCK_ROWS`` rows a block up to ``2**CUT_BITS`` blocks.

Only block totals meet in one task. The results equal the plain window's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 200_000
CUT_BITS = 11  # values are cut into at most 2**CUT_BITS blocks
HALO_BITS = 14
TASK_ROWS = 1_500_000


def _running_before(value: str, window) -> Column:
    """Sum of ``value`` over the rows strictly before the current one."""
    return F.sum(value).over(window) - F.col(value)


def in_bounded_tasks(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """``df`` of ``n_rows`` dealt by ``keys``, so that a task sorts about ``TASK_ROWS`` rows at most and need not spill.

    Left as it is where the session's own number of partitions does that.
    """
    wanted = -(-n_rows // TASK_ROWS)
    return df.repartition(wanted, *keys) if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _blocked(df: DataFrame, value: str, rows: int, by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``df`` with ``_block``, ascending in ``value`` inside ``by``, and its number of rows with a value.

    One aggregate brings the count and the values at even shares of the rows to the driver: fewer
    than ``2**CUT_BITS`` numbers for each of the few ``by``. Values are placed as doubles; where two
    fall together they share a block, so blocks never go against the order.
    """
    n = 1 << CUT_BITS
    at = F.percentile_approx(value, [i / n for i in range(1, n)], 8 * n)
    found = df.groupBy(*by).agg(F.count(value).alias("_n"), at.alias("_at")).collect()
    placed, own = df.withColumn("_value", F.col(value).cast("double")), []
    for i, row in enumerate(found):
        blocks = min(n, max(1, row["_n"] // rows))
        cuts = sorted({float(row["_at"][-(-k * n // blocks) - 1]) for k in range(1, blocks)}) if blocks > 1 else []
        if not cuts:
            continue
        splits = [-math.inf, *cuts, math.inf]
        placed = Bucketizer(splits=splits, inputCol="_value", outputCol=f"_in{i}", handleInvalid="keep").transform(placed)
        here = reduce(Column.__and__, [F.col(c).eqNullSafe(row[c]) for c in by], F.lit(True))
        own.append(F.when(here, F.col(f"_in{i}").cast("int")))
    if not own:  # few rows: two blocks, cut at zero, as a constant block would turn joins on it into cross joins
        placed = Bucketizer(splits=[-math.inf, 0.0, math.inf], inputCol="_value", outputCol="_in0", handleInvalid="keep").transform(placed)
        own.append(F.col("_in0").cast("int"))
    located = placed.withColumn("_block", F.coalesce(*own, F.lit(0))).drop("_value", *[f"_in{i}" for i in range(max(1, len(found)))])
    return located, sum(row["_n"] for row in found)


def id_blocks(df: DataFrame, uid: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``_block``: ranges of ids of about ``rows`` rows each, ascending."""
    return _blocked(df, uid, rows)[0]


def dense_index(df: DataFrame, uid: str, order: Sequence[str], name: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the rows 1..n in the order of ``(uid, *order)``; that combination must be unique.

    The one-task step sums block totals: at most ``2**CUT_BITS`` rows.
    """
    blocked = id_blocks(df, uid, rows)
    totals = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = totals.select("_block", _running_before("_n", Window.orderBy("_block")).alias("_start"))
    inside = Window.partitionBy("_block").orderBy(uid, *order)
    numbered = blocked.withColumn("_row", F.row_number().over(inside))
    return numbered.join(starts, "_block").withColumn(name, F.col("_start") + F.col("_row")).drop(
        "_block", "_row", "_start"
    )


def positions(df: DataFrame, by: Sequence[str], key: str, uid: str, position: str = "_pos",
              total: str = "_total", rows: int = BLOCK_ROWS) -> DataFrame:
    """Row number of every row inside ``by`` in the order ``(key, uid)``, and the group's row count.

    ``key`` must have a bounded domain (wear minutes, a two-decimal sensor): the widest window holds
    one row per distinct key of a group, the next one row per id block of a (group, key).
    """
    by = list(by)
    blocked, n = _blocked(df, uid, rows)
    sizes = blocked.groupBy(*by, key, "_block").agg(F.count(F.lit(1)).alias("_n"))
    in_key = Window.partitionBy(*by, key)
    sizes = sizes.select(
        *by, key, "_block",
        _running_before("_n", in_key.orderBy("_block")).alias("_block_start"),
        F.sum("_n").over(in_key).alias("_key_n"),
    )
    in_group = Window.partitionBy(*by)
    keys = sizes.groupBy(*by, key).agg(F.max("_key_n").alias("_n"))
    keys = keys.select(
        *by, key,
        _running_before("_n", in_group.orderBy(key)).alias("_key_start"),
        F.sum("_n").over(in_group).alias(total),
    )
    starts = sizes.join(keys, [*by, key]).select(
        *by, key, "_block", (F.col("_key_start") + F.col("_block_start")).alias("_start"), total
    )
    inside = Window.partitionBy(*by, key, "_block").orderBy(uid)
    numbered = in_bounded_tasks(blocked, n, *by, key, "_block").withColumn("_row", F.row_number().over(inside))
    return numbered.join(starts, [*by, key, "_block"]).withColumn(
        position, F.col("_start") + F.col("_row")
    ).drop("_block", "_row", "_start")


def ntile(position: Column, total: Column, buckets: int) -> Column:
    """NTILE from a 1-based position: the first ``total % buckets`` buckets hold one row more."""
    small = F.floor(total / buckets)
    larger = total % buckets
    boundary = larger * (small + 1)
    in_large = F.floor((position - 1) / (small + 1)) + 1
    in_small = larger + F.floor((position - 1 - boundary) / F.greatest(small, F.lit(1))) + 1
    return F.when(position <= boundary, in_large).otherwise(in_small).cast("int")


def value_ranks(df: DataFrame, by: Sequence[str], key: str, descending: bool = False) -> DataFrame:
    """Per distinct ``(by, key)``: rows with it, rows ordered before it, rows in the group.

    ``rank = rows_before + 1`` and ``percent_rank = rows_before / (rows_total - 1)``. The counts are
    combined before the shuffle; the window holds one row per distinct key of a bounded domain.
    """
    by = list(by)
    counts = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("rows_equal"))
    group = Window.partitionBy(*by)
    ordered = group.orderBy(F.col(key).desc() if descending else F.col(key).asc())
    return counts.select(
        *by, key, "rows_equal",
        _running_before("rows_equal", ordered).alias("rows_before"),
        F.sum("rows_equal").over(group).alias("rows_total"),
    )


def percent_rank(before: Column, total: Column) -> Column:
    return F.when(total > 1, before / (total - 1)).otherwise(F.lit(0.0))


def cumulate(df: DataFrame, by: Sequence[str], value: str, sums: Sequence[str], bounded: bool = False,
             rows: int = BLOCK_ROWS) -> DataFrame:
    """Running totals ``cum_<s>`` of ``sums`` in ascending ``value`` inside ``by``.

    ``df`` holds one row per distinct ``(by, value)`` and few distinct ``by``. With ``bounded`` the
    caller states that a group's distinct values are few and a plain window is used; otherwise a
    group is cut at approximate quantiles of its values into blocks of about ``rows`` of them.
    """
    by = list(by)
    running = [f"cum_{s}" for s in sums]
    if bounded:
        ordered = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.sum(s).over(ordered) for c, s in zip(running, sums)})
    located, _ = _blocked(df, value, rows, by)
    totals = located.groupBy(*by, "_block").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    across = Window.partitionBy(*by).orderBy("_block")
    starts = totals.select(*by, "_block", *[_running_before(f"_t_{s}", across).alias(f"_s_{s}") for s in sums])
    inside = Window.partitionBy(*by, "_block").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = located.withColumns({f"_c_{s}": F.sum(s).over(inside) for s in sums})
    return local.join(starts, [*by, "_block"]).withColumns(
        {c: F.col(f"_s_{s}") + F.col(f"_c_{s}") for c, s in zip(running, sums)}
    ).drop("_block", *[f"_c_{s}" for s in sums], *[f"_s_{s}" for s in sums])


def trailing_frames(df: DataFrame, by: Sequence[str], position: str, preceding: int, outputs: dict,
                    bits: int = HALO_BITS) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW`` in the order of ``position``.

    ``position`` is 1-based and dense inside ``by``. Each block of positions also receives the
    ``preceding`` rows before it; those copies complete the frames and are dropped afterwards.
    ``outputs`` maps a name to a function from the frame to a column.
    """
    size = 1 << bits
    if preceding >= size:
        raise ValueError("the frame must be shorter than a block")
    zero = F.col(position) - 1
    block = F.shiftright(zero, bits)
    in_next_halo = zero % size >= size - preceding
    copies = F.when(in_next_halo, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("_home", block).withColumn("_block", F.explode(copies))
    frame = Window.partitionBy(*by, "_block").orderBy(position).rowsBetween(-preceding, 0)
    computed = spread.withColumns({name: make(frame) for name, make in outputs.items()})
    return computed.where(F.col("_home") == F.col("_block")).drop("_home", "_block")


def sequence_by_key(df: DataFrame, key: str, uid: str, carried: str, number: str, previous: str,
                    rows: int = BLOCK_ROWS) -> DataFrame:
    """``ROW_NUMBER`` and ``LAG(carried)`` per ``key`` in ``uid`` order, for keys of any size.

    Each key is cut into id blocks. A block that is not its key's first takes the number of rows and
    the last carried value from the blocks before it; all other blocks need nothing.
    """
    blocked = id_blocks(df, uid, rows)
    inside = Window.partitionBy(key, "_block").orderBy(uid)
    local = blocked.withColumns({
        "_row": F.row_number().over(inside),
        "_prev": F.lag(carried).over(inside),
        "_end": F.lead(uid).over(inside).isNull(),
    })
    ends = local.where("_end").select(key, "_block", F.col("_row").alias("_n"), F.col(carried).alias("_last"))
    across = Window.partitionBy(key).orderBy("_block")
    carry = ends.select(
        key, "_block",
        _running_before("_n", across).alias("_start"),
        F.lag("_last").over(across).alias("_carry"),
    ).where(F.col("_start") > 0)
    joined = local.join(carry, [key, "_block"], "left")
    return joined.withColumns({
        number: (F.coalesce("_start", F.lit(0)) + F.col("_row")).cast("long"),
        previous: F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col("_prev")),
    }).drop("_block", "_row", "_prev", "_end", "_start", "_carry")
