"""Short row-frame windows over groups of any size.

A frame such as "the 29 rows before this one" needs only a row's neighbours, yet
``Window.partitionBy(key)`` brings the whole group into one task. The rows are
therefore numbered by key and order and cut into blocks of consecutive rows; each
block also gets copies of the neighbouring rows its frames reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from forgemeter.operators.ordering import with_running_total

# Most rows of a group in one task, the copies aside.
BLOCK_ROWS = 2_000_000


def neighbour_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the columns ``build(window)`` makes over (partition by keys order by order).

    The columns may look at most ``before`` rows back and ``after`` rows ahead,
    and (keys, order) must be unique. Runs a job.
    """
    if max(before, after) > block_rows:
        raise ValueError("the frame must fit into one block")
    numbered = with_running_total(df, [*[F.col(k).asc_nulls_first() for k in keys], *order], "_pos")
    block = F.call_function("div", F.col("_pos"), F.lit(block_rows))
    place = F.pmod(F.col("_pos"), F.lit(block_rows))
    homes = F.array(
        block,
        F.when(place >= block_rows - before, block + 1),
        F.when(place < after, block - 1),
    )
    spread = numbered.select("*", block.alias("_home"), F.explode(F.array_compact(homes)).alias("_block"))
    columns = build(Window.partitionBy("_block", *keys).orderBy("_pos"))
    return (
        spread.select("*", *[c.alias(name) for name, c in columns.items()])
        .filter(F.col("_block") == F.col("_home"))
        .drop("_pos", "_home", "_block")
    )
