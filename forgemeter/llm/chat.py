"""Preference formatting: one prompt, two masked completions.

The longest common prefix of turns of a chosen and a rejected conversation is
rendered once as the prompt. What follows in each is its completion, with the
code point ranges of the prompt and completion text that are to be learned: the
assistant's texts and their end marks. Everything else is masked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template of a turn and the role that is learned.
START, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"

_SPANS = "array<struct<start:bigint,stop:bigint>>"
_FORMATTED = (
    f"prompt_turns bigint, prompt string, chosen string, chosen_spans {_SPANS}, "
    f"rejected string, rejected_spans {_SPANS}"
)


def render(turns: list[tuple[str, str]], start: int = 0) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns and what is learned in it, counted from ``start``."""
    parts, spans, at = [], [], start
    for role, text in turns:
        head = f"{START}{role}{AFTER_ROLE}"
        parts += [head, text, END]
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(text) + len(END)))
        at += len(head) + len(text) + len(END)
    return "".join(parts), spans


def _turns(values: list[dict] | None) -> list[tuple[str, str]]:
    return [(value["role"], value["text"]) for value in values or []]


def _format(names: list[str], schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            chosen_column = batch.column(len(names)).to_pylist()
            rejected_column = batch.column(len(names) + 1).to_pylist()
            for chosen, rejected in zip(map(_turns, chosen_column), map(_turns, rejected_column), strict=True):
                shared = 0
                while shared < min(len(chosen), len(rejected)) and chosen[shared] == rejected[shared]:
                    shared += 1
                prompt, _ = render(chosen[:shared])
                row = [shared, prompt]
                for turns in (chosen, rejected):
                    text, spans = render(turns[shared:], len(prompt))
                    row += [text, [{"start": a, "stop": b} for a, b in spans]]
                rows.append(row)
            made = [pa.array([row[i] for row in rows], schema.field(i).type) for i in range(len(schema))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + made, names=names + schema.names
            )

    return run


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id") -> DataFrame:
    """One row per ``pair`` in either table: prompt_turns, prompt, and text and spans of both completions.

    Both have ``pair``, ``turn``, ``role`` and ``text``. Turns go by turn number,
    then role and text; null roles and texts are empty; a pair missing on one
    side has no turns there; null pair ids are one pair; repeated rows are
    repeated turns; other columns are ignored; empty tables give an empty result.
    One shuffle; a conversation is one row, so it must fit in a task.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    both = chosen.select(pair, turn.alias("turn"), F.lit(True).alias("chosen")).unionByName(
        rejected.select(pair, turn.alias("turn"), F.lit(False).alias("chosen"))
    )

    def side(wanted: Column, name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(wanted, F.col("turn")))).alias(name)

    sides = both.groupBy(pair).agg(side(F.col("chosen"), "c"), side(~F.col("chosen"), "r"))
    pairs = f"{pair} {dict(sides.dtypes)[pair]}, "
    list_of_span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema(
        [
            ("prompt_turns", pa.int64()),
            ("prompt", pa.string()),
            ("chosen", pa.string()),
            ("chosen_spans", list_of_span),
            ("rejected", pa.string()),
            ("rejected_spans", list_of_span),
        ]
    )
    return sides.mapInArrow(_format([pair], schema), pairs + _FORMATTED)


def with_stale_reply(conversations: DataFrame) -> DataFrame:
    """The conversations with their last assistant text replaced by their assistant's one before, or by nothing.

    A rejected side for tables that hold only good conversations: the reply
    answers an earlier question. The last turn is the one of the largest (turn,
    text), null turns and texts below all others; copies of it are replaced as
    well, by its own text. Conversations without an assistant's turn stay as they
    are.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    # Ranks up to a limit are cut off before the shuffle, so a conversation is two rows a task, however long it is.
    place = Window.partitionBy("conv_id").orderBy(F.desc("turn"), F.desc("said"))
    latest = (
        conversations.filter(F.col("role") == LEARNED)
        .select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("said"))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= 2)
    )
    last = latest.groupBy(F.col("conv_id").alias("__conv")).agg(
        F.max(F.when(F.col("place") == 1, F.struct("turn", "said"))).alias("__last"),
        F.max(F.when(F.col("place") == 2, F.col("said"))).alias("__before"),
    )
    own = F.struct("turn", F.coalesce("text", F.lit("")).alias("said"))
    is_last = (F.col("role") == LEARNED) & own.eqNullSafe(F.col("__last"))
    stale = F.coalesce("__before", F.lit(""))
    return conversations.join(last, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        "conv_id", "turn", "role", F.when(is_last, stale).otherwise(F.col("text")).alias("text")
    )
