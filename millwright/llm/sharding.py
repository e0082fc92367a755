"""Balanced label propagation: equal texts move to one shard under byte quotas; DataFrame functions only.

Documents with equal texts are linked. Linked documents start in shards drawn by a hash; in each
round every group counts its documents by shard, and those outside the group's leading shard move there.
Sizes stay within the quota, an even share of all bytes and ``SLACK``: where the moves into a shard
exceed its room and what leaves it, small parts of groups go first and the first part class that does not
fit goes by a share of its rows. A group larger than a shard thus fills whole shards one after the
other. Rounds end when nothing moves. Documents without links then fill every shard up to its even
share, in the order of a hash, so sizes differ from even by less than one document.

No step holds a group or a shard in one task: parts of groups are counted before they are shuffled,
running totals are taken in blocks of about ``BLOCK_ROWS`` rows, and the driver sees sums by shard
and part class only. ``law`` is ``bytes``.

Defined cases: a null text has no bytes (size 1) and equals the empty text. Repeated rows are
documents of their own; a null doc_id stays null. Empty tables give an empty table. Extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import discard, stored, two_hashes, whole_text

SHARDS = 8
ROUNDS = 16
#: Linked documents may fill a shard up to this share beyond even.
SLACK = 0.01
BLOCK_ROWS = 50_000
ROW = ["row", "doc_id", "size", "text_crc32", "h1", "h2"]


def _rows(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document with its own number, size, checksum, text hashes and first shard."""
    text = whole_text()
    h1, h2 = two_hashes(text, "text:")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    return rows.select(
        "row", "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        h1.alias("h1"), h2.alias("h2"), F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
    )


def _by_shard(frame: DataFrame, shards: int, column: str = "shard", value: str = "bytes") -> list[int]:
    found = {r[0]: r[1] for r in frame.groupBy(column).agg(F.sum(value)).collect()}  # one row per shard
    return [int(found.get(s) or 0) for s in range(shards)]


def _pick(values: list, column: str) -> Column:
    """The value of the list at a shard column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(column) + 1)


def _accepted(wanted: list, loads: list[int], quota: float) -> tuple[list[int], list[float], float]:
    """(last class, share of it, bytes) to accept into each shard of the moves (from, to, class, bytes).

    Starts from all moves and takes back what would exceed the quota, given what leaves each shard by
    the moves still accepted; taking back only ever shrinks, so this ends within the quota.
    """
    shards = len(loads)
    last, share = [64] * shards, [1.0] * shards
    part = lambda to, size_class: 1.0 if size_class < last[to] else share[to] if size_class == last[to] else 0.0
    for _ in range(100):
        leaving = [sum(b * part(to, c) for source, to, c, b in wanted if source == s) for s in range(shards)]
        before = (list(last), list(share))
        for to in range(shards):
            room = max(0.0, quota - loads[to] + leaving[to])
            for size_class in range(65):  # small parts first
                size = sum(b for _, t, c, b in wanted if t == to and c == size_class) if size_class < 64 else 0
                if size > room:
                    last[to], share[to] = min((last[to], share[to]), (size_class, room / size))
                    break
                room -= size
        if (last, share) == before:
            break
    return last, share, sum(b * part(to, c) for _, to, c, b in wanted)


def propagate(linked: DataFrame, quota: float, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``linked`` with shards after label propagation; each round is written to the shared folder.

    Every other round looks at shards with room alone, so groups whose leading shard is full gather
    in the next best.
    """
    now, path, idle = linked, None, 0
    for turn in range(rounds):
        parts = now.groupBy("h1", "h2", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
        loads = _by_shard(parts, shards)
        rank = F.struct("n", F.pmod(F.xxhash64("h1", "shard"), F.lit(1 << 20)).alias("draw"), "shard")
        ranked = parts.select("*", rank.alias("rank"), F.floor(F.log2("bytes")).cast("int").alias("class"))
        leading = ranked if turn % 2 == 0 else ranked.where(_pick([load < quota for load in loads], "shard"))
        lead = leading.groupBy("h1", "h2").agg(F.max("rank").alias("lead"))
        moves = (
            ranked.join(lead, ["h1", "h2"]).where((F.col("shard") != F.col("lead.shard")) & (F.col("rank") < F.col("lead")))
            .select("h1", "h2", "shard", "bytes", "class", F.col("lead.shard").alias("to"))
        )
        wanted = moves.groupBy("shard", "to", "class").agg(F.sum("bytes").alias("bytes")).collect()  # at most 64 classes for each pair of shards
        last, share, gained = _accepted([tuple(r) for r in wanted], loads, quota)
        idle = idle + 1 if gained < 1 else 0
        if not wanted and turn % 2 == 0 or idle == 2:
            break
        if gained < 1:
            continue
        # a part goes whole but for those too large to matter little
        drawn = F.when(F.col("bytes") > quota / 100, F.xxhash64("row", F.lit(turn))).otherwise(F.xxhash64("h1", "h2", F.lit(turn)))
        draw = F.pmod(drawn, F.lit(1 << 30)) / float(1 << 30)
        goes = (F.col("class") < _pick(last, "to")) | ((F.col("class") == _pick(last, "to")) & (draw < _pick(share, "to")))
        moved = now.join(moves, ["h1", "h2", "shard"], "left")
        then, then_path = stored(moved.select(*ROW, F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")), "shards")
        if path:
            discard(now.sparkSession, path)
        now, path = then, then_path
    return now


def _running(frame: DataFrame, parts: list[str], value: Column, name: str, rows: int) -> DataFrame:
    """``frame`` with the running total of ``value`` in the order of a hash of the row number, this row
    included, per ``parts``; totals of hash blocks are carried from block to block."""
    blocks = max(1, rows // BLOCK_ROWS)
    cut = frame.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "row"), F.lit(blocks)))
    sums = cut.groupBy(*parts, "block").agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy(*parts).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*parts, "block", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*parts, "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.withColumn("inside", F.sum(value).over(inside))
    return totals.join(before, [*parts, "block"]).withColumn(name, F.col("before") + F.col("inside")).drop("block", "before", "inside")


def _filled(pool: DataFrame, loads: list[int], quota: float, count: int) -> DataFrame:
    """``pool`` with the shards that bring every load up to ``quota``, in the order of a hash."""
    ends, at = [], 0.0
    for load in loads:
        at += max(0.0, quota - load)
        ends.append(at)
    middle = F.col("sum") - F.col("size") / 2
    place = F.lit(len(loads) - 1)
    for shard in range(len(loads) - 2, -1, -1):
        place = F.when(middle <= ends[shard], F.lit(shard)).otherwise(place)
    return _running(pool, [], F.col("size"), "sum", count).select(*ROW, place.alias("shard"))


def _small(classes: list, least: int) -> int:
    """The largest size of the lowest classes that hold ``least`` bytes."""
    held = 0
    for row in classes:
        held += row["bytes"]
        if held >= least:
            return row["most"]
    return classes[-1]["most"]


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, h1, h2) per row of ``docs``."""
    rows, _ = stored(_rows(docs, shards), "documents")
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    quota = total / shards
    groups = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    moved = propagate(stored(rows.join(groups, ["h1", "h2"], "left_semi").select(*ROW, "shard"), "linked")[0], (1 + SLACK) * quota, shards)
    loads = _by_shard(moved, shards, value="size")
    over = [s for s in range(shards) if loads[s] > (1 + SLACK) * quota]
    pool = rows.join(groups, ["h1", "h2"], "left_anti").select(*ROW)
    if over:  # what a share of rows put beyond the quota joins the documents that may go anywhere
        full = _running(moved.where(F.col("shard").isin(over)), ["shard"], F.col("size"), "sum", count)
        pool = pool.union(full.where(F.col("sum") > (1 + SLACK) * quota).select(*ROW))
        moved = moved.where(~F.col("shard").isin(over)).union(full.where(F.col("sum") <= (1 + SLACK) * quota).select(*ROW, "shard"))
        loads = _by_shard(moved, shards, value="size")
    classes = pool.groupBy(F.floor(F.log2("size")).alias("class")).agg(F.sum("size").alias("bytes"), F.max("size").alias("most")).orderBy("class").collect()  # at most 64
    largest = max([r["most"] for r in classes], default=0)
    small = _small(classes, 4 * shards * largest) if largest > quota / 1000 else largest
    if small < largest:  # large documents first, so that what they leave uneven is filled with small ones
        coarse = pool.where(F.col("size") > small)
        rest = total - sum(r["bytes"] for r in classes if r["most"] <= small)
        placed, _ = stored(_filled(coarse, loads, max(rest / shards, *loads), count), "large")
        moved = moved.select(*ROW, "shard").union(placed)
        loads = _by_shard(moved, shards, value="size")
        pool = pool.where(F.col("size") <= small)
    filled = _filled(pool, loads, quota, count)
    placed, _ = stored(moved.select(*ROW, "shard").union(filled), "placed")
    numbered = _running(placed, ["shard"], F.lit(1), "slot", count)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot") - 1).cast("long").alias("slot"), "h1", "h2")


def cut_links(assigned: DataFrame) -> DataFrame:
    """(linked, cut): documents linked to their group's largest shard, and how many of them lie elsewhere."""
    parts = assigned.groupBy("h1", "h2", "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where("n > 1")
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linked"), F.coalesce(F.sum(F.col("n") - F.col("most")), F.lit(0)).alias("cut"))
