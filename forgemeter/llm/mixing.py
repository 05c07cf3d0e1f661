"""Mixing sources to target weights by Efraimidis-Spirakis sampling, all in DataFrame functions.

Each source gets a share of a word budget by its weight, at most ``epochs``
times its own size; what is above is shared again by weight. A source's target
is filled with complete epochs first; the rest is a sample without replacement:
every document draws u from a hash of its id, its key is -ln(u) / quality, and
documents are taken in order of their keys until the budget is full. The
document at the edge gives only the words that are missing, so a source meets
its target to the word. Nothing depends on the run or the partitioning.

A source may hold any share of the rows: the order is one range partitioning
over (source, key), and running totals are added from range totals
(``operators.ordering``); no task holds a source. Only the table of sources,
one row each, is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.llm.words import WORD, id_key, text_key, unused
from forgemeter.operators.ordering import with_running_total
from forgemeter.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2

# Fixed value: characters that count against a text's quality.
SYMBOLS = "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def symbol_weight(text: Column, words: Column) -> Column:
    """A document's quality weight, 1 without symbols, falling with symbols per word."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0)).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * symbols / F.greatest(words, F.lit(1)).cast("double"))


def uniform(doc_id: Column) -> Column:
    """A number between 0 and 1, ends excluded, from 52 bits of the id's MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """Adds ``rank`` (by code point, null last), ``start`` (words of earlier sources) and ``target``.

    ``sources`` has one row per ``source`` with its ``source_size``. With sources
    in order of epochs * size / weight, the level at a source is the budget not
    used up by earlier, capped ones per weight left; the first source whose cap
    is above its level sets the level for all that follow.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    earlier = by_name.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1
    )
    ranked = (
        sources.withColumn("rank", F.row_number().over(by_name))
        .withColumn("start", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    by_fill = Window.orderBy("fill", "rank")
    everything = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ) / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    free = F.when(F.col("fill") > F.col("level"), F.struct("fill", "rank", "level"))
    return (
        ranked.withColumn("level", level)
        .withColumn("common", F.min(free).over(everything)["level"])
        .withColumn(
            "target",
            F.when(F.col("common").isNull() | (F.col("fill") <= F.col("common")), F.col("cap").cast("double")).otherwise(
                F.col("weight") * F.col("common")
            ),
        )
        .select("source", "source_size", "rank", "start", "target")
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """doc_id, source, text_key, size, source_size, target, taken: one row per row of ``docs``.

    ``size`` is the number of words (null text: 0), ``taken`` the words the mix
    takes of the document, repeats counted: never over ``epochs`` times its size.
    A null source is a source of its own, the last. Repeated rows count each;
    extra columns are ignored; an empty table gives an empty result.
    """
    words = word_count(F.col("text"))
    sized = settle(
        docs.select(
            "doc_id",
            "source",
            text_key().alias("text_key"),
            words.alias("size"),
            (-F.log(uniform(F.col("doc_id"))) / symbol_weight(F.col("text"), words)).alias("key"),
        ),
        "sizes",
    )
    sources = settle(
        source_targets(
            sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs
        ),
        "sources",
    )
    named = F.coalesce(sized["source"], F.lit("")) == F.coalesce(sources["source"], F.lit(""))
    joined = sized.join(sources, named & (sized["source"].isNull() == sources["source"].isNull())).drop(sources["source"])
    ordered = with_running_total(
        joined,
        [F.col("rank").asc(), F.col("key").asc(), id_key().asc(), F.col("size").asc(), F.col("text_key").asc()],
        "before",
        weight="size",
    )
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    turns = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("bigint")).otherwise(F.lit(0))
    left = budget - turns * F.col("source_size") - (F.col("before") - F.col("start"))
    return ordered.select(
        "doc_id",
        "source",
        "text_key",
        "size",
        "source_size",
        "target",
        (turns * F.col("size") + F.greatest(F.lit(0), F.least("size", left))).cast("bigint").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """The mix as rows of ``docs``: a document comes as often as the mix takes its words.

    Texts stay whole: the document at the edge of a source's budget comes once
    more if at least half of it is taken. Documents without words are not drawn.
    Rows equal in id, source and text are one document here, its repeats summed.
    """
    key, source, text, count, turn = (unused(docs, f"__{name}") for name in ("id", "source", "text", "times", "turn"))
    keys = [id_key().alias(key), F.coalesce(F.col("source"), F.lit("")).alias(source)]
    times = (
        mix(docs, weights, share, epochs)
        .filter("size > 0")
        .select(*keys, F.col("text_key").alias(text), F.floor(F.col("taken") / F.col("size") + 0.5).alias("n"))
        .groupBy(key, source, text)
        .agg(F.sum("n").cast("int").alias(count))
        .filter(F.col(count) > 0)
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, *keys, text_key().alias(text)).dropDuplicates([key, source, text])
    return keyed.join(times, [key, source, text]).withColumn(
        turn, F.explode(F.sequence(F.lit(1), F.col(count)))
    ).select(*columns)
