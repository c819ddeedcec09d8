"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at `replicas` points of a ring of CELLS cells. A row belongs
to the first point at or after its cell, by the md5 of its key. Shard loads are
bounded by exact capacities (total rows over shards, rounded up for the first
shards and down for the rest), so all shards end full and their row counts are
at most one apart: the law is `rows`.

A shard's capacity is divided among its points in proportion to the rows that
fall to them. A point keeps its own rows as far as its share goes; the rows over
it continue clockwise to the next points with room. Nothing else moves. On the
ring, the k-th row over (counted from the place where nothing is carried over)
meets the k-th free place, so all moves follow from running sums over points.

Only DataFrame operations; the tables of cells, points and segments have sizes
fixed by parameters (65,536 cells, shards x replicas points), which is what is
broadcast. Rows are ranked per cell, not per shard.

Defined results: null text has 0 bytes and crc32 0; a null key is the empty
string; equal keys are ordered by size, then crc32, and equal rows are
interchangeable. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
ROW_BYTES = 16  # counted for every row besides its text


def _position(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def points(spark, shards: int, replicas: int) -> DataFrame:
    """(point, cell, shard) clockwise; `point` numbers them from 0."""
    every = spark.range(shards * replicas).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("replica")
    )
    placed = every.withColumn("cell", F.shiftright(_position(F.concat_ws(":", "shard", "replica")), 16))
    order = Window.orderBy("cell", "shard", "replica")
    return placed.select((F.row_number().over(order) - 1).alias("point"), "cell", "shard")


def arcs(ring: DataFrame) -> DataFrame:
    """(cell, turn, point): the point each cell belongs to; `turn` orders cells clockwise from after the last point."""
    last = F.max("cell").over(Window.partitionBy())
    before = F.coalesce(F.lag("cell").over(Window.orderBy("point")), last - CELLS)
    spans = ring.select("point", (before + 1).alias("first"), F.col("cell").alias("until")).where("first <= until")
    return spans.select("point", F.explode(F.sequence("first", "until")).alias("turn")).select(F.pmod("turn", F.lit(CELLS)).alias("cell"), "turn", "point")


def segments(ring: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """(point, low, high, shard, came, base): rows ranked low..high-1 at a point go to the shard's slots from base on.

    `loads` is (point, n)."""
    n_shards, all_points = F.lit(shards), Window.partitionBy()
    in_shard = Window.partitionBy("shard")
    x = ring.join(loads, "point", "left").select("point", "shard", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(all_points)
    x = x.withColumn("cap", F.expr(f"sum(n) over () div {shards}") + (F.col("shard") < total % n_shards).cast("int"))
    x = x.withColumn("w", F.when(F.sum("n").over(in_shard) == 0, 1).otherwise(F.col("n")))
    x = x.withColumn("w_all", F.sum("w").over(in_shard)).withColumn("w_before", _before(F.col("w"), in_shard.orderBy("point")))
    x = x.withColumn("c", F.expr("((w_before + w) * cap) div w_all - (w_before * cap) div w_all"))
    x = x.withColumn("over", F.greatest(F.col("n") - F.col("c"), F.lit(0))).withColumn("free", F.greatest(F.col("c") - F.col("n"), F.lit(0)))
    carried = F.sum(F.col("over") - F.col("free")).over(Window.orderBy("point"))
    x = x.withColumn("carried", carried)
    # start after the point where the least is carried: from there on, rows over always precede the room they find
    start = F.min(F.struct("carried", "point")).over(all_points)["point"]
    x = x.withColumn("turn", F.pmod(F.col("point") - start - 1, F.count("*").over(all_points)))
    turn = Window.orderBy("turn")
    x = x.withColumn("over_before", _before(F.col("over"), turn)).withColumn("free_before", _before(F.col("free"), turn))
    starts = (
        x.where("over > 0").select(F.col("over_before").alias("at"), F.col("turn").alias("from_turn"), F.lit(None).cast("bigint").alias("to_turn"))
        .unionByName(x.where("free > 0").select(F.col("free_before").alias("at"), F.lit(None).cast("bigint").alias("from_turn"), F.col("turn").alias("to_turn")))
        .groupBy("at").agg(F.max("from_turn").alias("from_turn"), F.max("to_turn").alias("to_turn"))
    )
    along = Window.orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    moved = starts.select(
        "at", F.lead("at").over(along).alias("end"), F.max("from_turn").over(so_far).alias("from_turn"), F.max("to_turn").over(so_far).alias("to_turn")
    )
    source = x.select(F.col("turn").alias("from_turn"), "point", "c", "over_before", "over")
    target = x.select(F.col("turn").alias("to_turn"), "shard")
    low = F.col("c") + F.col("at") - F.col("over_before")
    gone = moved.join(source, "from_turn").join(target, "to_turn").select(
        "point", low.alias("low"), (low + F.coalesce(F.col("end"), F.col("over_before") + F.col("over")) - F.col("at")).alias("high"), "shard", F.col("to_turn").alias("turn"), F.lit(1).alias("came")
    )
    stay = x.where("least(n, c) > 0").select("point", F.lit(0).cast("bigint").alias("low"), F.least("n", "c").alias("high"), "shard", "turn", F.lit(0).alias("came"))
    both = stay.unionByName(gone)
    filled = Window.partitionBy("shard").orderBy("turn", "came", "point", "low")
    return both.select("point", "low", "high", "shard", "came", _before(F.col("high") - F.col("low"), filled).alias("base"))


def place(docs: DataFrame, shards: int = 40, replicas: int = 64, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot, moved): `slot` counts from 0 in each shard without gaps;
    `moved` tells the rows that a full shard passed on."""
    rows = docs.select(
        key,
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        _position(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("__pos"),
    ).withColumn("__cell", F.shiftright("__pos", 16))
    ring = points(docs.sparkSession, shards, replicas)
    counts = rows.groupBy(F.col("__cell").alias("cell")).agg(F.count("*").alias("n"))
    cells = arcs(ring).join(counts, "cell").withColumn("before", _before(F.col("n"), Window.partitionBy("point").orderBy("turn")))
    loads = cells.groupBy("point").agg(F.sum("n").alias("n"))
    parts = segments(ring, loads, shards)
    found = rows.join(F.broadcast(cells.select(F.col("cell").alias("__cell"), F.col("point").alias("__point"), F.col("before").alias("__before"))), "__cell")
    ranked = found.withColumn("__rank", F.col("__before") + F.row_number().over(Window.partitionBy("__cell").orderBy("__pos", key, "size", "text_crc32")) - 1)
    parts = parts.select(F.col("point").alias("__point"), F.col("low").alias("__low"), F.col("high").alias("__high"), F.col("shard").alias("__shard"), F.col("base").alias("__base"), F.col("came").alias("__came"))
    at = (F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high"))
    out = ranked.join(F.broadcast(parts.withColumnRenamed("__point", "__p")), (F.col("__point") == F.col("__p")) & at)
    return out.select(
        key, "size", "text_crc32", F.col("__shard").cast("int").alias("shard"), (F.col("__base") + F.col("__rank") - F.col("__low")).cast("bigint").alias("slot"), (F.col("__came") == 1).alias("moved")
    )
