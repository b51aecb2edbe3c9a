"""Top rows, positions and samples.

Spark limits ``rank`` and ``row_number`` filters on the map side already, so only a group's best
rows travel. Orders that cut off rows must end in a unique column to give the same rows every time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.session import stored

Order = Sequence[Column | str]


#: Up to this many rows per group a rank filter is applied before the shuffle.
GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    """The first ``k`` rows of an order. Each task keeps its own ``k``; one merges them."""
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return top_k(df, [F.asc(key)], n)


def last_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return top_k(df, [F.desc(key)], n)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Order, k: int, ties: bool = True, position: str | None = None
) -> DataFrame:
    """The first ``k`` rows per group.

    With ``ties`` rows equal to the last one stay too (rank), otherwise exactly ``k`` (row number). Ties
    of a group meet in one task, so they suit ranks over few rows, such as the totals of teams.
    ``position`` names a column for the place reached. Spark cuts each group to ``k`` before the shuffle
    only up to its limit; a larger ``k`` would gather whole groups in one task each and is refused.
    """
    limit = int(df.sparkSession.conf.get(GROUP_LIMIT_KEY, "1000"))
    if k > limit:
        raise ValueError(f"k is {k}, above {GROUP_LIMIT_KEY} = {limit}: number the rows with ordered_index instead")
    window = Window.partitionBy(*group).orderBy(*order)
    place = F.rank() if ties else F.row_number()
    name = position or "_place"
    best = df.withColumn(name, place.over(window)).where(F.col(name) <= k)
    return best if position else best.drop(name)


def lowest_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows that hold their group's lowest value, ties included, for groups and ties of any number.

    The lowest values are aggregated and joined back, so no group is gathered in one task. Both reads
    must see the same values: stored ones, or sums of whole numbers. Averages of fractions may differ
    in the last digit from one run to the next; rank those with ``top_k_per_group``.
    """
    renamed = {key: f"_low_{key}" for key in group}
    keys = [F.col(key).alias(renamed[key]) for key in group]
    lows = df.groupBy(*keys).agg(F.min(value).alias("_low"))
    same = [F.col(key).eqNullSafe(F.col(renamed[key])) for key in group]
    return df.join(lows, [*same, F.col(value) == F.col("_low")], "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Order) -> DataFrame:
    """The newest version of each key."""
    return top_k_per_group(df, keys, newest_first, 1, ties=False)


def position_in_group(df: DataFrame, group: Sequence[str], order: Order, name: str = "Pos") -> DataFrame:
    """1, 2, 3 ... in each group's order, for groups of few rows such as the teams of a league.

    A group is numbered by one task. ``ordered_index`` numbers groups of any size.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def ordered_index(df: DataFrame, order: Order, group: Sequence[str] = (), name: str = "Pos") -> DataFrame:
    """1, 2, 3 ... over the whole order, or in each group, without gathering any group in one task.

    The rows are range-partitioned and sorted once, and stored in the shared folder with the number of
    their partition and their place in it. A row's number is its place plus the sizes of the partitions
    before; only these sizes, one row per partition, pass through a single task. ``order`` has to end in
    a unique column.
    """
    part = F.spark_partition_id()
    # The id holds the partition number above bit 33 and the place in the partition below it.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tagged = stored(df.orderBy(*group, *order).select("*", part.alias("_part"), place.alias("_place")), "ordered")
    if group:
        return _index_in_groups(tagged, list(group), name).select(*df.columns, name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = tagged.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select(F.col("_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the sort, so the broadcast side is bounded by the partition count.
    indexed = tagged.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_place") + 1)
    return indexed.select(*df.columns, name)


def _index_in_groups(tagged: DataFrame, group: list[str], name: str) -> DataFrame:
    """Places within groups of rows that are sorted by group and tagged with ``_part`` and ``_place``.

    A row's place in its group is its place in the part less that of the group's first row there. Only
    a part's first group can have begun in earlier parts: what it has there is the sum over the parts
    that end with it without a break, one row per part in a single window. Rows meet their group's first
    place by (part, group), so a group of any size is spread over as many keys as it has parts.
    """
    pieces = tagged.groupBy("_part", *group).agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    key = F.struct(*group)
    parts = pieces.groupBy("_part").agg(
        F.min_by(key, "_first").alias("_head"),
        F.max_by(key, "_first").alias("_tail"),
        F.max_by("_size", "_first").alias("_last"),
        F.count("*").alias("_groups"),
    )
    by_part = Window.orderBy("_part")
    linked = parts.withColumn("_linked", F.coalesce(F.col("_head") == F.lag("_tail").over(by_part), F.lit(False)))
    # A chain of parts with one group each goes on as long as the group does.
    chain = F.sum(F.when(F.col("_linked") & (F.col("_groups") == 1), 0).otherwise(1)).over(by_part)
    chained = linked.withColumn("_chain", chain)
    sums = chained.withColumn("_upto", F.sum("_last").over(Window.partitionBy("_chain").orderBy("_part")))
    carried = sums.select("_part", F.when(F.col("_linked"), F.lag("_upto").over(by_part)).otherwise(0).alias("_before"))
    starts = pieces.join(carried, "_part").select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)],
        (F.when(F.col("_first") == 0, F.col("_before")).otherwise(0) - F.col("_first")).alias("_shift"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(group)]
    met = tagged.join(starts, [F.col("_part") == F.col("_p"), *same])
    return met.withColumn(name, F.col("_place") + F.col("_shift") + 1)


def value_ranks(df: DataFrame, group: Sequence[str], order: Mapping[str, bool]) -> DataFrame:
    """The distinct values of ``order`` in each group with their ``_rank`` and ``_dense`` rank.

    ``order`` tells for each column whether it ascends. Ties are counted before any shuffle, so a tie of
    any size is one row. The counted values are range-partitioned and summed up from part to part, so
    a group of any number of values is spread over many tasks; where a group goes on from one part to
    the next is told by one row per part.
    """
    keys = [*group, *order]
    sort = [*(F.asc(g) for g in group), *(F.asc(c) if up else F.desc(c) for c, up in order.items())]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tagged = stored(counts.orderBy(*sort).select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), "ranks")
    by_part, earlier = Window.orderBy("_part"), (Window.unboundedPreceding, -1)

    def before(column: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(*earlier)), F.lit(0))

    sizes = tagged.groupBy("_part").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_values"))
    starts = sizes.select("_part", before("_rows", by_part).alias("_rows0"), before("_values", by_part).alias("_values0"))
    # One row per partition of the sort, so the broadcast side is bounded by the partition count.
    numbered = (
        tagged.withColumn("_in_part", before("_n", Window.partitionBy("_part").orderBy("_place")))
        .join(F.broadcast(starts), "_part")
        .withColumn("_at", F.struct((F.col("_rows0") + F.col("_in_part")).alias("rows"), (F.col("_values0") + F.col("_place")).alias("values")))
    )
    pieces = numbered.groupBy("_part", *group).agg(F.min("_at").alias("_at0"), F.min("_place").alias("_first"))
    name = F.struct(F.lit(0), *group)  # a struct needs a field where there is no group
    parts = pieces.groupBy("_part").agg(
        F.min_by(name, "_first").alias("_head"),
        F.max_by(name, "_first").alias("_tail"),
        F.max_by("_at0", "_first").alias("_tail_at"),
        F.count("*").alias("_groups"),
    )
    linked = parts.withColumn("_linked", F.col("_head").eqNullSafe(F.lag("_tail").over(by_part)))
    # A part that lies within one group that began earlier begins none.
    begun = linked.withColumn("_begun", F.when(~F.col("_linked") | (F.col("_groups") > 1), F.col("_tail_at")))
    carried = begun.select("_part", "_linked", F.last("_begun", ignorenulls=True).over(by_part.rowsBetween(*earlier)).alias("_carried"))
    group_starts = pieces.join(carried, "_part").select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)],
        F.when((F.col("_first") == 0) & F.col("_linked"), F.col("_carried")).otherwise(F.col("_at0")).alias("_start"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(group)]
    met = numbered.join(group_starts, [F.col("_part") == F.col("_p"), *same])
    return met.select(
        *keys,
        (F.col("_at.rows") - F.col("_start.rows") + 1).alias("_rank"),
        (F.col("_at.values") - F.col("_start.values") + 1).alias("_dense"),
    )


def with_ranks(
    df: DataFrame, group: Sequence[str], order: Mapping[str, bool], rank: str = "rank", dense: str | None = None, k: int | None = None
) -> DataFrame:
    """``df`` with the rank of each row in its group, and its dense rank if ``dense`` names a column for it.

    For groups and ties of any size, unlike a window over the group. With ``k`` only rows of rank ``k`` or
    better stay. ``df`` is read twice and must give the same rows both times.
    """
    ranks = value_ranks(df, group, order)
    if k is not None:
        ranks = ranks.where(F.col("_rank") <= k)
    keys = [*group, *order]
    named = ranks.select(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(keys)], "_rank", "_dense")
    same = [F.col(c).eqNullSafe(F.col(f"_k{n}")) for n, c in enumerate(keys)]
    extra = [F.col("_rank").alias(rank), *([F.col("_dense").alias(dense)] if dense else [])]
    return df.join(named, same).select(*df.columns, *extra)


def sample_by_suffix(
    df: DataFrame, id_column: str, suffixes: Sequence[str], n: int, order: Order | None = None, mark: str = "_"
) -> DataFrame:
    """First ``n`` rows whose id has no ``mark``, and first ``n`` for each id suffix.

    A row that ends in two of the suffixes counts for both, as in a union of the samples.
    """
    ident = F.col(id_column)
    strata = [F.when(~ident.contains(mark), F.lit(""))]
    strata += [F.when(ident.endswith(suffix), F.lit(suffix)) for suffix in suffixes]
    tagged = df.withColumn("_stratum", F.explode(F.array_compact(F.array(*strata))))
    return top_k_per_group(tagged, ["_stratum"], order or [F.asc(id_column)], n, ties=False).drop("_stratum")
