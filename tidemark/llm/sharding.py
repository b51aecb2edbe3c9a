"""Uniform sharding with exact shard sizes: a drawn communication matrix and two permutations.

A uniform shuffle of all rows into shards of given sizes moves from partition p to shard s a number of
rows that follows the multivariate hypergeometric law. Drawing these numbers first turns the global
shuffle into local ones: each partition permutes its rows and deals them out by its row of the matrix,
the rows are exchanged, and each shard permutes what it got. DataFrame functions only.

The matrix is drawn by halving: the counts of a range of partitions are split into those of its left
and right half. Ranges of one level are drawn independently, each in a row of its own and spread over
tasks, in as many stored levels as the number of partitions has binary digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import fresh
from tidemark.llm.tables import stored

#: Rows of a shard that are put in order together. More rows make more buckets, not larger ones.
BUCKET_ROWS = 100_000
#: Standard deviations to either side of the mode that a draw reaches; what lies beyond has a chance below 1e-60.
REACH = 18
#: Tasks that the draws of one level are dealt out to at most.
DRAW_TASKS = 256


def uniform(*parts: Column) -> Column:
    """A repeatable number in [0, 1) for a key."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` of ``total`` items are among the ``marked``, for a uniform ``u``.

    Inverts the distribution outward from its mode, where the chances are largest, in ratios to the
    chance of the mode, so no factorial of a large number is needed.
    """

    # Fields of a lambda's argument are computed once a draw, columns put into its steps once a step.
    def bounded(g: Column) -> Column:
        low, high = F.greatest(F.lit(0).cast("long"), g["drawn"] + g["marked"] - g["total"]), F.least(g["drawn"], g["marked"])
        mode = F.least(high, F.greatest(low, F.floor((g["drawn"] + 1) * ((g["marked"] + 1) / (g["total"] + 2)))))
        rest = g["total"] - g["marked"] - g["drawn"]
        fields = {"total": g["total"], "marked": g["marked"], "drawn": g["drawn"], "u": g["u"], "low": low, "high": high, "mode": mode, "rest": rest}
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    given = F.struct(*[c.cast("long").alias(name) for name, c in (("total", total), ("marked", marked), ("drawn", drawn))], u.alias("u"))
    return F.transform(F.transform(F.array(given), bounded), _inverted)[0]


def _inverted(g: Column) -> Column:
    """The draw, for a struct of its three numbers, the uniform number, the bounds, the mode and the rest."""
    zero, one = F.lit(0.0), F.lit(1.0)
    total, marked, drawn, u, low, high, mode, rest = (g[n] for n in ("total", "marked", "drawn", "u", "low", "high", "mode", "rest"))
    spread = F.sqrt(drawn * (marked / total) * (1 - marked / total) + 1)
    steps = F.least(F.greatest(high - mode, mode - low), F.ceil(REACH * spread) + 10)
    way = F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(F.array().cast("array<long>"))

    def weights(up: Column, down: Column, k: Column) -> tuple[Column, Column]:
        """Relative chances at ``mode + k`` and ``mode - k`` from those one step nearer."""
        x, y = mode + k - 1, mode - k + 1
        above = F.when(mode + k <= high, up * ((marked - x) / (x + 1)) * ((drawn - x) / (rest + x + 1))).otherwise(zero)
        below = F.when(mode - k >= low, down * (y / (marked - y + 1)) * ((rest + y) / (drawn - y + 1))).otherwise(zero)
        return above, below

    def add(state: Column, k: Column) -> Column:
        up, down = weights(state["up"], state["down"], k)
        return F.struct((state["sum"] + up + down).alias("sum"), up.alias("up"), down.alias("down"))

    def seek(state: Column, k: Column) -> Column:
        up, down = weights(state["up"], state["down"], k)
        left, open_ = state["left"], state["at"].isNull()
        at = F.when(~open_, state["at"]).when(left < up, mode + k).when(left < up + down, mode - k)
        return F.struct((left - up - down).alias("left"), at.alias("at"), up.alias("up"), down.alias("down"))

    weight = F.aggregate(way, F.struct(one.alias("sum"), one.alias("up"), one.alias("down")), add)["sum"]
    aim = u * weight
    found = F.aggregate(
        way,
        F.struct((aim - 1).alias("left"), F.when(aim < 1, mode).alias("at"), one.alias("up"), one.alias("down")),
        seek,
    )["at"]
    return F.when((drawn <= 0) | (marked <= 0), F.lit(0).cast("long")).when(low == high, low).otherwise(F.coalesce(found, mode))


def communication_matrix(counts: DataFrame, shard_sizes: list[int], seed: int = 0) -> DataFrame:
    """``part, moves`` (array of counts per shard) for ``counts`` (``part`` from 0 on, ``n``).

    Every row of the matrix sums to the partition's ``n``, every column to the shard's size. ``counts``
    has one row per partition. A range of partitions is a node of a binary tree, and a row of its level.
    """
    parts = counts.select(F.col("part").cast("long").alias("part"), F.col("n").cast("long").alias("n"))
    depth = int(parts.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]).bit_length()
    levels = parts.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), "part", "n")
    node = F.expr(f"shiftright(part, {depth} - level)").alias("node")
    nodes = stored(levels.groupBy("level", node).agg(F.sum("n").alias("n")), "ranges")
    sizes = F.array(*[F.lit(int(s)).cast("long") for s in shard_sizes])
    ranges = nodes.filter("level = 0").select("node", "n", sizes.alias("moves"))
    for level in range(depth):
        left = nodes.filter((F.col("level") == level + 1) & (F.col("node") % 2 == 0))
        left = left.select(F.shiftright("node", 1).alias("node"), F.col("n").alias("wanted"))
        known = ranges.join(left, "node", "left").select("node", "n", F.coalesce("wanted", F.lit(0)).alias("wanted"), "moves")
        # A number of its own keeps the few rows of a level in as many tasks; the next level reads what was drawn.
        ranges = stored(_halved(known.repartition(min(1 << level, DRAW_TASKS), "node"), level, seed), "matrix")
    return ranges.select(F.col("node").alias("part"), "moves").join(parts.select("part"), "part", "left_semi")


def _halved(ranges: DataFrame, level: int, seed: int) -> DataFrame:
    """Every range (``wanted`` of its ``n`` rows are in its left half) as its two halves, its counts divided by a draw."""

    def deal(state: Column, pair: Column) -> Column:
        u = uniform(F.lit(seed), F.lit("matrix"), F.lit(level), F.col("node"), pair["shard"])
        taken = hypergeometric(state["total"], pair["size"], state["wanted"], u)
        # One evaluation of the draw serves both the rest and the result.
        return F.transform(
            F.array(taken),
            lambda x: F.struct(
                (state["total"] - pair["size"]).alias("total"),
                (state["wanted"] - x).alias("wanted"),
                F.array_append(state["out"], x).alias("out"),
            ),
        )[0]

    pairs = F.transform("moves", lambda size, shard: F.struct(size.alias("size"), shard.alias("shard")))
    start = F.struct(F.col("n").alias("total"), F.col("wanted").alias("wanted"), F.array().cast("array<long>").alias("out"))
    drawn = ranges.withColumn("left", F.aggregate(pairs, start, deal)["out"])
    half = F.explode(
        F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("wanted").alias("n"), F.col("left").alias("moves")),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                (F.col("n") - F.col("wanted")).alias("n"),
                F.zip_with("moves", "left", lambda a, b: a - b).alias("moves"),
            ),
        )
    )
    return drawn.select(half.alias("half")).select("half.*")


def shard_uniformly(rows: DataFrame, shards: int = 16, seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one at most and every assignment of rows to places is equally likely. Nulls,
    repeated rows and any columns are carried along; ``rows`` must not already have ``shard`` or ``slot``.
    An empty table gives an empty one. The rows are written once to the shared folder, so partition
    numbers stay what they were when an executor is lost. Two exchanges move rows: one within the
    partitions' numbers, one to (shard, bucket); neither depends on a data key, so none can be hot.
    """
    part, row, order, place, bucket = (fresh(rows, n) for n in ("part", "row", "order", "place", "bucket"))
    owner, ends, of_shard, of_bucket, before = (fresh(rows, n) for n in ("owner", "ends", "of_shard", "of_bucket", "before"))
    numbered = stored(rows.withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()), "shards")
    counts = numbered.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    sums = F.transform("moves", lambda _, i: F.aggregate(F.slice("moves", 1, i + 1), F.lit(0).cast("long"), lambda a, b: a + b))
    matrix = stored(communication_matrix(counts, sizes, seed).select(F.col("part").alias(owner), sums.alias(ends)), "matrix")

    # The partition's own permutation; then the first moves[0] rows go to shard 0, the next to shard 1 ...
    permuted = numbered.withColumn(order, F.xxhash64(F.lit(seed), F.lit("local"), row)).withColumn(
        place, F.row_number().over(Window.partitionBy(part).orderBy(order, row))
    )
    dealt = permuted.join(matrix, F.col(part) == F.col(owner)).withColumn(
        "shard", F.size(F.filter(ends, lambda e: e < F.col(place)))
    )
    # The shard's permutation: by a random key whose leading part is a bucket of bounded size.
    buckets = max(1, -(-max(sizes) // bucket_rows))
    dealt = dealt.withColumn(order, F.xxhash64(F.lit(seed), F.lit("shard"), row)).withColumn(
        bucket, F.pmod(F.shiftright(order, 20), F.lit(buckets)).cast("int")
    ).drop(ends, owner, part, place)
    held = dealt.groupBy(F.col("shard").alias(of_shard), F.col(bucket).alias(of_bucket)).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(of_shard).orderBy(of_bucket).rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(of_shard, of_bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy("shard", bucket).orderBy(order, row)) - 1
    return (
        dealt.withColumn("slot", inside)
        .join(held, (F.col("shard") == F.col(of_shard)) & (F.col(bucket) == F.col(of_bucket)))
        .withColumn("slot", F.col("slot").cast("long") + F.col(before))
        .drop(of_shard, of_bucket, before, bucket, order, row)
    )
