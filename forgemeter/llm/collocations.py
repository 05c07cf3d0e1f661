"""Phrase collocations by prefix-free parsing.

Parsing. A text is cut into pieces and those into words. Wherever a window of
four words hashes to a trigger, a chunk ends with that window and the next one
begins with it, so equal passages give equal chunks wherever they stand, and
neighbours overlap by the four words that a phrase of five starting before the
window may reach into. Pieces too long for a trigger are cut at fixed distances
from the last one. The distinct chunks of a language with their number of
occurrences are the dictionary and its parse frequencies.

Counting. Phrases are counted inside the distinct chunks, times the chunk's
frequency; a phrase belongs to the chunk whose own words (``own``, those before
the overlap) hold its first word, so overlaps count once. Counts go up by
length, one pass for words, one for pairs, one for all longer phrases: a phrase
can only occur ``least`` times if all shorter ones in it do, so those that do
are put into a bitmap of hashes, and only phrases all of whose parts are in it
leave a task. The bitmap grows with the number of frequent phrases up to
``MOST_BITS``; being too full makes it let more through, never less, and what
comes through is counted exactly.

Scores, cuts and the containment rule are joins and groupings over the frequent
phrases; no phrase table is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.llm.bpe import in_portions
from forgemeter.llm.words import text_bytes
from forgemeter.session import settle

LONGEST = 5
LEAST = 100
# The lengths counted in one pass over the dictionary.
PASSES = ((1,), (2,), (3, 4, 5))
TOP = 2_000
UNKNOWN = "und"

# A trigger in about so many windows; the farthest cut where none comes.
TRIGGER = 16
LONGEST_CHUNK = 256

# Words of chunks looked at together in a task.
WORDS_AT_ONCE = 400_000

BITS_A_PHRASE = 32
LEAST_BITS = 1 << 18
MOST_BITS = 1 << 29
BITMAP_BITS = 8 * 4_096

# What ends a piece, and what ends a word inside one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64(0x100000001B3)


# Parsing --------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (values ^ (values >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _content(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number per word from its length and first eight bytes; enough to set triggers by."""
    eight = np.lib.stride_tricks.sliding_window_view(buffer, 8)[starts].copy().view("<u8").ravel()
    spare = np.uint64(8) * (np.uint64(8) - np.minimum(lengths, 8).astype(np.uint64))
    eight = (eight << spare) >> spare
    return _mixed(eight * _MIX + lengths.astype(np.uint64))


def chunks_of(texts: list[bytes], trigger: int = TRIGGER, longest: int = LONGEST_CHUNK):
    """Chunks of all texts, in order: (number of the text, words of its own, the words space-joined)."""
    overlap = LONGEST - 1
    data = b"\n".join(texts).lower() + b"\n"
    buffer = np.frombuffer(data, np.uint8)
    kind = _KIND[buffer]
    inside = np.concatenate([[False], kind == 0])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return []
    # A word begins a piece if the piece's number differs from that of the word before.
    pieces = np.cumsum(kind == 2)[starts]
    words = len(starts)
    begins = np.concatenate([[True], pieces[1:] != pieces[:-1]])
    piece_stop = np.append(np.flatnonzero(begins)[1:], words)[np.cumsum(begins) - 1]

    # Words next to each other with one space between: the byte after a word is kept as its space.
    compact = kind == 0
    compact[ends] = True
    clean = np.where(kind == 0, buffer, np.uint8(32))[compact]
    lengths = ends - starts
    clean_starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    clean_ends = clean_starts + lengths

    number = _content(np.concatenate([clean, np.zeros(8, np.uint8)]), clean_starts, lengths)
    window = np.zeros(words, np.uint64)
    for i in range(overlap):
        shifted = np.roll(number, -i)
        window = window * np.uint64(31) + shifted
    place = np.arange(words)
    cut = (_mixed(window) % np.uint64(trigger) == 0) & (place + overlap <= piece_stop)
    cut |= begins
    at = np.flatnonzero(cut)
    gaps = np.diff(np.append(at, words))
    if len(at) and gaps.max() > longest:
        far = np.flatnonzero(gaps > longest)
        more = [np.arange(at[i] + longest, at[i] + gaps[i], longest) for i in far]
        at = np.sort(np.concatenate([at, *more]))
    own = np.diff(np.append(at, words))
    # The last chunk of a piece has no overlap; others reach over the window that ends them.
    last = np.minimum(at + own + overlap, piece_stop[at]) - 1
    document = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts[at], side="right")
    joined = clean.tobytes()
    bodies = [joined[a:b] for a, b in zip(clean_starts[at].tolist(), clean_ends[last].tolist(), strict=True)]
    return list(zip(document.tolist(), own.tolist(), bodies, strict=True))


def _parse(trigger: int, longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True))
            for portion in in_portions(rows, lambda row: len(row[1])):
                found = chunks_of([text for _, text in portion], trigger, longest)
                langs = pa.array([lang for lang, _ in portion], pa.string())
                which, own, bodies = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(pa.array(which, pa.int64())),
                        pa.array(own, pa.int32()),
                        pa.array(bodies, pa.binary()).cast(pa.string()),
                    ],
                    names=["lang", "own", "chunk"],
                )

    return run


def dictionary(docs: DataFrame, trigger: int = TRIGGER, longest: int = LONGEST_CHUNK) -> DataFrame:
    """lang, own, chunk, times: the distinct chunks of each language and how often they occur.

    Equal chunks collapse in the task that finds them and again in the shuffle.
    """
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    chunks = rows.mapInArrow(_parse(trigger, longest), "lang string, own int, chunk string")
    return chunks.groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("times"))


# The bitmap of frequent phrases ---------------------------------------------


class Bitmap:
    """Hashes of phrases; a phrase that was put in is always found."""

    def __init__(self, bits: int, pages: dict[int, bytes]):
        self.bits = bits
        self.data = np.zeros(bits // 8, np.uint8)
        for page, data in pages.items():
            at = page * (BITMAP_BITS // 8)
            self.data[at : at + len(data)] = np.frombuffer(data, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bit = bit_of(hashes, self.bits)
        return (self.data[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def bit_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(hashes) % np.uint64(bits)).astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A number per word from all its bytes."""
    data = words.cast(pa.binary()).combine_chunks() if isinstance(words, pa.ChunkedArray) else words.cast(pa.binary())
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    content = data.buffers()[2]
    values = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]] if content else np.zeros(0, np.uint8)
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.cumprod(np.full(int(lengths.max(initial=0)), _PRIME), dtype=np.uint64)
    terms = (values + np.uint64(1)) * powers[np.arange(len(values)) - np.repeat(starts, lengths)]
    sums = np.zeros(len(data), np.uint64)
    some = lengths > 0
    if some.any():
        sums[some] = np.add.reduceat(terms, starts[some])
    return _mixed(sums)


def _with_word(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all its words but the last, and the last one's."""
    return prefix * _PRIME + word


def _in_language(words: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return words ^ (lang * _MIX)


def _bits(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.split_pattern(batch.column(1), " ")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            own = _in_language(word_hashes(lists.flatten()), np.repeat(word_hashes(batch.column(0)), sizes))
            first = np.cumsum(sizes) - sizes
            hashes = own[first]
            for i in range(1, int(sizes.max(initial=1))):
                more = sizes > i
                hashes[more] = _with_word(hashes[more], own[first[more] + i])
            bit = bit_of(hashes, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bit // BITMAP_BITS), pa.array(bit % BITMAP_BITS)], names=["page", "bit"]
            )

    return run


def bitmap_of(phrases: DataFrame, bits: int | None = None) -> Bitmap:
    """A bitmap of at most ``MOST_BITS`` bits over ``lang, phrase``. Runs jobs."""
    if bits is None:
        wanted = max(LEAST_BITS, phrases.count() * BITS_A_PHRASE)
        bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    pages = (
        phrases.select("lang", "phrase")
        .mapInArrow(_bits(bits), "page bigint, bit bigint")
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("data"))
    )
    return Bitmap(bits, {row["page"]: bytes(row["data"]) for row in pages.collect()})


# Counting -------------------------------------------------------------------


def _count_portion(rows: pa.Table, lengths: tuple[int, ...], bitmap: Bitmap | None) -> Iterator[pa.RecordBatch]:
    """Phrases of these lengths in the chunks all of whose shorter parts may be frequent, with their occurrences.

    The bitmap, if any, is over the phrases a word shorter than the shortest.
    """
    own, times = rows["own"].to_numpy(), rows["times"].to_numpy()
    lists = pc.split_pattern(rows["chunk"].combine_chunks(), " ")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    word = encoded.indices.to_numpy(zero_copy_only=False)
    langs = rows["lang"].combine_chunks().dictionary_encode()
    chunk = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lang = langs.indices.to_numpy(zero_copy_only=False)[chunk]
    left = sizes[chunk] - place
    take = place < own[chunk]
    if bitmap is not None:
        hashes = own_hash = _in_language(word_hashes(encoded.dictionary)[word], word_hashes(langs.dictionary)[lang])
        for i in range(1, lengths[0] - 1):
            hashes = _with_word(hashes, np.roll(own_hash, -i))
        frequent = bitmap.holds(hashes)
        take &= frequent
    for length in lengths:
        if bitmap is not None:
            take &= np.roll(frequent, lengths[0] - 1 - length)
        at = np.flatnonzero(take & (left >= length))
        keys = {"lang": lang[at], **{f"w{i}": word[at + i] for i in range(length)}}
        counted = (
            pa.table({**keys, "times": times[chunk[at]]})
            .group_by(list(keys), use_threads=False)
            .aggregate([("times", "sum")])
            .combine_chunks()
        )
        spelled = [encoded.dictionary.take(counted[f"w{i}"].combine_chunks()) for i in range(length)]
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(counted["lang"].combine_chunks()),
                pc.binary_join_element_wise(*spelled, " ") if length > 1 else spelled[0],
                pa.array(np.full(counted.num_rows, length, np.int32)),
                counted["times_sum"].combine_chunks().cast(pa.int64()),
            ],
            names=["lang", "phrase", "words", "times"],
        )


def _counter(lengths: tuple[int, ...], shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value if shared else None
        held: list[pa.RecordBatch] = []
        words = 0
        for batch in batches:
            held.append(batch)
            words += int(batch.column(1).to_numpy().sum())
            if words >= WORDS_AT_ONCE:
                yield from _count_portion(pa.Table.from_batches(held), lengths, bitmap)
                held, words = [], 0
        if held:
            yield from _count_portion(pa.Table.from_batches(held), lengths, bitmap)

    return run


def phrase_counts(
    chunks: DataFrame, lengths: tuple[int, ...], least: int = LEAST, shorter: Bitmap | None = None
) -> DataFrame:
    """lang, phrase, words, a: the phrases of these lengths, consecutive ones, with at least ``least`` occurrences.

    ``shorter`` holds all phrases a word shorter than the shortest that have as many.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(shorter) if shorter else None
    parts = chunks.select("lang", "own", "chunk", "times").mapInArrow(
        _counter(lengths, shared), "lang string, phrase string, words int, times bigint"
    )
    return parts.groupBy("lang", "phrase", "words").agg(F.sum("times").alias("a")).filter(F.col("a") >= least)


def frequent_phrases(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, words, a for all lengths up to ``LONGEST``; each pass is written before the next. Runs jobs."""
    found, bitmap = None, None
    for lengths in PASSES:
        counted = settle(phrase_counts(chunks, lengths, least, bitmap), f"phrases-{lengths[0]}")
        if lengths != PASSES[-1]:
            bitmap = bitmap_of(counted)
        found = counted if found is None else found.unionByName(counted)
    return found


# Scores ---------------------------------------------------------------------


def _words(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("_words", start, size), " ")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every phrase of two words or more, by its lowest-scoring cut.

    The parts of a frequent phrase are frequent, so joins with the same table find them.
    """
    several = phrases.filter("words > 1").withColumn("_words", F.split("phrase", " "))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        _words(F.lit(1), F.col("k")).alias("_first"),
        _words(F.col("k") + 1, F.col("words") - F.col("k")).alias("_rest"),
    )
    firsts = phrases.select("lang", F.col("phrase").alias("_first"), F.col("a").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("_rest"), F.col("a").alias("r"))
    joined = cuts.join(firsts, ["lang", "_first"]).join(rests, ["lang", "_rest"]).join(totals, "lang")
    # As 38-digit whole numbers; DIV of those is exact and gives a BIGINT.
    above = (_exact("a") * _exact("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", above, _exact("l") * _exact("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut")
    return (
        joined.groupBy("lang", "phrase", "words", "a", "n")
        .agg(lowest)
        .select("lang", "phrase", "words", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    )


def uncontained(candidates: DataFrame) -> DataFrame:
    """The candidates but those inside a longer one that occurs as often."""
    longer = candidates.filter("words > 2").withColumn("_words", F.split("phrase", " "))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda start: F.array_join(F.slice("_words", start, size), " "),
            ),
        )
    )
    inside = (
        longer.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("_longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("_longer").alias("_longer"))
    )
    return (
        candidates.join(inside, ["lang", "phrase"], "left")
        .filter(F.col("_longer").isNull() | (F.col("_longer") < F.col("a")))
        .drop("_longer")
    )


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, trigger: int = TRIGGER, longest: int = LONGEST_CHUNK
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of two to five words. Runs jobs.

    Null texts are empty, a null language is ``und``; repeated rows count each
    time; doc_ids and extra columns are ignored. An empty table, or one where no
    phrase occurs ``least`` times, gives no row.
    """
    chunks = settle(dictionary(docs, trigger, longest), "dictionary")
    totals = settle(chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n")), "totals")
    phrases = frequent_phrases(chunks, least)
    candidates = settle(scored(phrases, totals), "candidates")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language's first ones are among the first of its parts, so no task sorts a language whole.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    firsts = (
        uncontained(candidates)
        .withColumn("_part", part)
        .withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        .filter(F.col("_place") <= top)
    )
    return (
        firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
