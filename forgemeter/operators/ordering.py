"""Totals, numbers and ranks over one global order, without one global task.

``Window.orderBy`` with no ``partitionBy`` moves every row into a single task.
Here the rows are range-partitioned on the whole sort key instead (Spark samples
it, so equal-sized ranges come out whatever the distribution), written once to
the shared scratch folder together with their range number, and each range gets
the total of the ranges before it. Sampled bounds differ from run to run; the
numbers do not, as long as the sort key is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.session import settle

# monotonically_increasing_id() is (partition number << 33) + row number.
ROW_BITS = 33


def with_running_total(
    df: DataFrame, order: Sequence[Column], out: str, weight: str | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (1 if not given) over all earlier rows.

    ``order`` must be unique over the rows. Runs jobs.
    """
    return _running_total(df, order, out, weight)[0]


def _running_total(
    df: DataFrame, order: Sequence[Column], out: str, weight: str | None
) -> tuple[DataFrame, int]:
    """As above; also returns the sum over all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = settle(
        ranged.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row")),
        "ranges",
    )
    if weight is None:
        size = F.count(F.lit(1))
        inside = F.col("_row") - F.shiftleft(F.col("_range").cast("bigint"), ROW_BITS)
    else:
        # Ranges are about equal in rows, so this window is spread evenly.
        earlier = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        size = F.sum(weight)
        inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))

    # One row per range, at most spark.sql.shuffle.partitions rows: few enough
    # to be added up here and sent along as a table of literals.
    sizes = kept.groupBy("_range").agg(size.cast("bigint").alias("_size")).orderBy("_range").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["_range"], total))
        total += row["_size"] or 0
    placed = df.sparkSession.createDataFrame(starts, "_range int, _start bigint")
    numbered = (
        kept.withColumn("_inside", inside)
        .join(F.broadcast(placed), "_range")
        .withColumn(out, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_range", "_row", "_inside", "_start")
    )
    return numbered, total


def with_row_number(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order), for a unique order. Runs jobs."""
    return with_running_total(df, order, "_before").withColumn(out, F.col("_before") + 1).drop("_before")


def with_ranks(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """RANK() OVER (ORDER BY value DESC NULLS LAST) for every ``{rank: value}``.

    Rank = 1 + rows with a strictly better value, which needs only how often
    each value occurs. Values are counted first (one shared by a third of the
    rows is one counted row), and the counts of all rankings are put in one
    order: by ranking, then by one column per type, so that values of different
    types share its ranges and each keeps its own type. Each rank is looked up
    by value. The lookups carry no hint: a short table of values is broadcast by
    its written size, a long one is sort-merge joined with AQE splitting a
    skewed value. Runs jobs.
    """
    rows = settle(df, "ranked-input")
    types = dict(rows.dtypes)
    kinds = list(dict.fromkeys(types[value] for value in ranks.values()))
    slots = {kind: f"_slot{i}" for i, kind in enumerate(kinds)}
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("_ranking"),
                *[
                    (F.col(value) if types[value] == kind else F.lit(None)).cast(kind).alias(slot)
                    for kind, slot in slots.items()
                ],
            )
            for i, value in enumerate(ranks.values())
        ]
    )
    counted = (
        rows.select(F.explode(entries).alias("_entry"))
        .select("_entry.*")
        .groupBy("_ranking", *slots.values())
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = [F.col("_ranking").asc(), *[F.col(slot).desc_nulls_last() for slot in slots.values()]]
    ordered, total = _running_total(counted, order, "_before", "_n")
    lookup = settle(ordered.drop("_n"), "ranks")
    result = rows
    for i, (out, value) in enumerate(ranks.items()):
        # Every ranking counts each row once, so ranking i starts after i shares of the total.
        start = i * (total // len(ranks))
        places = lookup.filter(F.col("_ranking") == i).select(
            F.col(slots[types[value]]).alias(f"_{out}"), (F.col("_before") - start + 1).cast("bigint").alias(out)
        )
        result = result.join(places, F.col(value).eqNullSafe(F.col(f"_{out}"))).drop(f"_{out}")
    return result.select(*df.columns, *ranks)
