"""Removing repeated passages by winnowing over line hashes.

Passages start and end inside lines, and a copy may be wrapped anew, so the
lines hashed are those of ``LINE`` words that begin at each word of a text,
wherever its own lines end. Winnowing slides over them in windows of ``words``
words and selects in each the line of the smallest hash, the leftmost of
several. Whatever run of ``words`` or more words two documents share holds such
a window, equal in both, so both select the same line in it: a shared run cannot
be missed. Windows next to each other mostly select the same line; they are one
row, the stretch of words that they cover.

Positions are joined on the selected line. Only lines that stand at several
places go on. Places whose whole stretches are equal need no further look: all
but the first are repeats. Where a line stands in different stretches, the match
is extended both ways, word by word, but for the first place of each different
stretch alone: its windows, one further word each, meet their first equals. A
passage that a third of all documents share so costs a row per place, and its
windows once for each different surrounding.

The result is exact: a word goes if and only if it lies in a run of ``words``
words that stands at an earlier place too, in order of doc_id and position.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.bpe import in_portions
from forgemeter.llm.words import NO_ID, id_key, text_bytes, text_key, unused
from forgemeter.session import settle

WORDS = 50
# Words of a hashed line. Longer ones stand at fewer places by chance, but more of them are selected.
LINE = 12

# Bytes whose words are hashed together; a longer word is hashed alone.
BYTES_AT_ONCE = 1 << 21

# A run's hash is a polynomial at _BASE over the hashes of its words, a word's over numbers of its bytes, modulo 2**64.
_BASE = 0x1F3D5B79A2C4E681
_BACK = pow(_BASE, -1, 2**64)
_SIZE = np.uint64(0x9E3779B97F4A7C15)

_IS_WORD = np.ones(256, np.uint8)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = 0

_STRETCHES = "id bigint, text bigint, line bigint, stretch bigint, start int, stop int"
_WINDOWS = "id bigint, text bigint, window bigint, start int"

# A word with the white space before it.
_WORD = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
_LINE_REST = re.compile(r"^[\x20\x09\x0B-\x0D]+(?=\n)")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.full(size, base, np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


_BYTES = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * _SIZE) * _SIZE)


class _Sums:
    """Hashes of the runs of a row of numbers, from running sums of numbers times powers."""

    def __init__(self, numbers: np.ndarray):
        # uint64 arithmetic wraps around, as it should. Powers are kept for sizes up to the next power of two.
        size = 1 << max(10, len(numbers).bit_length())
        self._back = _powers(_BACK, size)
        self._sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(numbers * _powers(_BASE, size)[: len(numbers)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        run = (self._sums[stops] - self._sums[starts]) * self._back[starts]
        return _mixed(run + (stops - starts).astype(np.uint64) * _SIZE)


class Runs:
    """Hashes of the runs of words of texts that follow each other."""

    def __init__(self, *texts: bytes):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = _IS_WORD[data]
        edges = np.flatnonzero(np.diff(inside, prepend=np.uint8(0)))
        starts, ends = edges[::2], edges[1::2]
        self.words = len(starts)
        numbers = np.zeros(self.words, np.uint64)
        cuts = np.searchsorted(starts, np.arange(0, len(data) + BYTES_AT_ONCE, BYTES_AT_ONCE))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if i < j:
                at = starts[i]
                numbers[i:j] = _Sums(_BYTES[data[at : ends[j - 1]]]).hashes(starts[i:j] - at, ends[i:j] - at)
        # The first word of each text, and the number of words at the end.
        begins = np.cumsum([0] + [len(text) + 1 for text in texts])
        self.firsts = np.searchsorted(starts, begins)
        self.hashes = _Sums(numbers).hashes


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value, the leftmost of several, of each ``width`` values in a row."""
    at, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        reach += step
    return at


def winnow_all(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, ...]:
    """(number of the text, hash of the selected line, hash of the stretch, start, stop) of each stretch, in words."""
    runs = Runs(*texts)
    # Windows that lie in one text, by their first word.
    sizes = np.maximum(np.diff(runs.firsts) - words + 1, 0)
    text = np.repeat(np.arange(len(texts)), sizes)
    windows = np.arange(len(text)) + np.repeat(runs.firsts[:-1] - np.cumsum(sizes) + sizes, sizes)
    if not len(windows):
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    line = min(LINE, words)
    places = np.arange(runs.words - line + 1)
    lines = runs.hashes(places, places + line)
    selected = leftmost_minima(lines, words - line + 1)[windows]
    # Windows of two texts never select the same line.
    breaks = np.flatnonzero(selected[1:] != selected[:-1])
    begin, end = np.append(0, breaks + 1), np.append(breaks, len(windows) - 1)
    starts, stops, first = windows[begin], windows[end] + words, runs.firsts[text[begin]]
    return text[begin], lines[selected[begin]], runs.hashes(starts, stops), starts - first, stops - first


def winnow(data: bytes, words: int = WORDS) -> tuple[np.ndarray, ...]:
    """The stretches of one text: hash of the selected line, hash of the stretch, start, stop."""
    return winnow_all([data], words)[1:]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Rows of a batch and their texts, a bounded portion at a time; a longer text comes alone."""
    texts = text_bytes(batch.column(2))
    for portion in in_portions(list(enumerate(texts)), lambda row: len(row[1])):
        rows, bodies = zip(*portion, strict=True)
        yield np.array(rows), list(bodies)


def _stretches(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _portions(batch):
                text, lines, stretches, starts, stops = winnow_all(texts, words)
                same = [batch.column(c).take(pa.array(rows[text])) for c in (0, 1)]
                places = [pa.array(a.astype(np.int32)) for a in (starts, stops)]
                yield pa.RecordBatch.from_arrays(
                    [*same, _signed(lines), _signed(stretches), *places],
                    names=["id", "text", "line", "stretch", "start", "stop"],
                )

    return run


def _windows(words: int):
    """The windows of the given stretches of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _portions(batch):
                runs = Runs(*texts)
                begins, ends = (batch.column(c).take(pa.array(rows)) for c in (3, 4))
                text = np.repeat(np.arange(len(texts)), [len(b) for b in begins])
                begin, end = (np.asarray(lists.flatten()) for lists in (begins, ends))
                sizes = (end - begin - words + 1).astype(np.int64)
                text = np.repeat(text, sizes)
                starts = np.arange(len(text)) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
                places = starts + runs.firsts[text]
                same = [batch.column(c).take(pa.array(rows[text])) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*same, _signed(runs.hashes(places, places + words)), pa.array(starts.astype(np.int32))],
                    names=["id", "text", "window", "start"],
                )

    return run


def repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``id``, ``text`` (keys of the document), ``starts``, ``stops`` of repeated runs, in words.

    One row per document that repeats an earlier run. Null ids come last. Rows
    equal in id and text are one document and no repeats of each other.
    """
    last = F.when(F.col("doc_id").isNull(), F.lit(2**63 - 1)).otherwise(id_key())
    keyed = docs.select(last.alias("id"), text_key().alias("key"), "text")
    found = settle(keyed.mapInArrow(_stretches(words), _STRETCHES), "stretches")

    # Lines at several places. Partial aggregates, so a common line is a row per task, here and below.
    place, number = F.struct("id", "text", "start", "stop"), F.xxhash64("id", "text", "start")
    several = (
        found.groupBy("line")
        .agg(
            (F.min(number) != F.max(number)).alias("several"),
            (F.min("stretch") != F.max("stretch")).alias("differ"),
        )
        .filter("several")
        .select("line", "differ")
    )
    shared = settle(found.join(several, "line"), "shared")
    firsts = settle(shared.groupBy("line", "stretch").agg(F.min(place).alias("first"), F.max("differ").alias("differ")), "firsts")
    copies = shared.join(firsts.select("line", "stretch", "first"), ["line", "stretch"]).filter(place != F.col("first"))

    # Matches that end inside stretches: windows of the first place of each different stretch of a line.
    open_ends = (
        firsts.filter("differ")
        .select("first.*")
        .groupBy("id", "text")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
        .withColumnRenamed("text", "key")
    )
    extended = settle(
        keyed.join(open_ends, ["id", "key"])
        .select("id", "key", "text", "starts", "stops")
        .mapInArrow(_windows(words), _WINDOWS),
        "windows",
    )
    at = F.struct("id", "text", "start")
    equals = (
        extended.groupBy("window")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("window", "first")
    )
    matched = extended.join(equals, "window").filter(at != F.col("first"))

    back = F.when(F.col("id") == 2**63 - 1, F.lit(NO_ID)).otherwise(F.col("id"))
    return (
        copies.select("id", "text", "start", "stop")
        .unionByName(matched.select("id", "text", "start", (F.col("start") + words).cast("int").alias("stop")))
        .groupBy("id", "text")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
        .select(back.alias("id"), "text", "starts", "stops")
    )


def cut_out(text: str, starts: list[int], stops: list[int]) -> str:
    """``text`` without those runs of words, each word with the white space before it.

    The rest of a line's white space goes with the last word gone from it, all
    white space at the end with the text's last word, and that before the first
    word left with words gone before it.
    """
    ends = [found.end() for found in _WORD.finditer(text)]
    edges = np.zeros(len(ends) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, stops, -1)
    gone = (np.cumsum(edges)[:-1] > 0).tolist()
    ends[-1] = len(text)
    kept = []
    for i, (start, stop) in enumerate(zip([0, *ends], ends, strict=False)):
        if not gone[i]:
            word = text[start:stop]
            kept.append(_LINE_REST.sub("", word) if i and gone[i - 1] else word)
    return "".join(kept).lstrip(_SPACE) if gone[0] else "".join(kept)


def _without(texts: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
    changed = pc.is_valid(starts)
    rows = zip(*(column.filter(changed).to_pylist() for column in (texts, starts, stops)), strict=True)
    return pc.replace_with_mask(texts, changed, pa.array([cut_out(*row) for row in rows], texts.type))


def without_repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with later repeats of runs of ``words`` or more words taken out of ``text``.

    Runs start and end at any word; white space between words is not compared. A
    document that repeats throughout keeps its row with an empty text; null
    texts stay null; shorter repeats stay; all other columns are kept. An empty
    table gives an empty result.
    """
    key, text, starts, stops = (unused(docs, name) for name in ("__id", "__text", "__starts", "__stops"))
    runs = repeated_runs(docs, words).withColumnsRenamed({"id": key, "text": text, "starts": starts, "stops": stops})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, id_key().alias(key), text_key().alias(text))
    joined = keyed.join(runs, [key, text], "left")
    rewritten = F.arrow_udf(_without, "string")("text", starts, stops)
    return joined.withColumn("text", rewritten).select(*columns)
