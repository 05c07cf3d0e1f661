"""SimHash near-duplicates found with pivot distance tables.

A fingerprint has 64 bits; bit b is set if it is set in more than half of the
XXH64 hashes (seed 42) of the text's word shingles. Two fingerprints are linked
if at most ``distance`` bits differ; the relation is exact, no pair is sampled
or capped.

How pairs are found. Hamming distances to a set of reference fingerprints
(pivots) are tabulated for every fingerprint. By the triangle inequality the
distances of a linked pair to any pivot differ by at most ``distance``, so a
pair is discarded on its largest coordinate difference, and only survivors are
compared bit by bit. On 64-bit fingerprints one pivot discards about two fifths
of random pairs, too little to compare everything with everything. So the bits
are cut into ``distance + 2`` slabs: a linked pair agrees in two slabs at least,
and fingerprints meet only in buckets of two equal slabs. In a bucket they are
ordered by their first pivot distance, and the tables do the rest.

No hot groups. Equal fingerprints collapse to one row first. A bucket with more
than ``HOT_BUCKET`` different fingerprints is cut again by its other bits: of
the ``2 * distance`` pieces of those bits a linked pair agrees in ``distance``,
so subsets of that size are further keys, and such a sub-bucket is bounded by
the few bits left. In a bucket each linked fingerprint points at one
representative; a group of mutual copies gives as many rows as members, not
pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.components import component_roots
from forgemeter.llm.words import id_key, text_bytes, text_key, unused
from forgemeter.session import settle

BITS = 64
SEED = 42
SHINGLE = 4
DISTANCE = 4
PIVOTS = 24
HOT_BUCKET = 2_000
HASHES_AT_ONCE = 65_536

# Reference fingerprints: far apart in expectation, equal on every machine.
_PIVOTS = np.random.default_rng(20_240_601).integers(0, 2**63, PIVOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# Fingerprints ---------------------------------------------------------------


def shingle_hashes(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words, A-Z lowered; of all words if there are fewer."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    pieces = [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; zero without words."""
    hashes = shingle_hashes(data, size)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(data, size) for data in text_bytes(texts)], np.uint64)
        return pa.array(values.view(np.int64), pa.int64())

    return of(text)


# Links ----------------------------------------------------------------------


def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _cuts(low: int, width: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``parts`` nearly equal pieces."""
    ends = [low + width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _bucket_keys(value: Column, distance: int) -> list[Column]:
    slabs = _cuts(0, BITS, distance + 2)
    keys = []
    for number, ((low1, width1), (low2, width2)) in enumerate(combinations(slabs, 2)):
        both = F.shiftleft(_bits(value, low1, width1), width2).bitwiseOR(_bits(value, low2, width2))
        keys.append(F.struct(F.lit(number).alias("slabs"), both.alias("bits")))
    return keys


def sub_keys(values: np.ndarray, slabs: int, distance: int) -> np.ndarray:
    """Further keys (columns) of fingerprints in a hot bucket of the given pair of equal slabs."""
    cuts = _cuts(0, BITS, distance + 2)
    equal = list(combinations(range(len(cuts)), 2))[slabs]
    pieces = [piece for i, cut in enumerate(cuts) if i not in equal for piece in _cuts(*cut, 2)]
    keys = []
    for number, subset in enumerate(combinations(pieces, distance)):
        key = np.full(len(values), number + 1, np.uint64)
        for low, width in subset:
            key = (key << np.uint64(width)) | ((values >> np.uint64(low)) & np.uint64((1 << width) - 1))
        keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


def _dealt(distance: int):
    """Rows (slabs, bits, fingerprint, hot) to (slabs, bits, sub, near, fingerprint); hot rows once per sub-key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slabs, bits, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            hot = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            yield rows(slabs[~hot], bits[~hot], np.zeros((~hot).sum(), np.int64), values[~hot])
            for number in np.unique(slabs[hot]):
                here = np.flatnonzero(hot & (slabs == number))
                for some in np.array_split(here, len(here) // 1_000 + 1):
                    keys = sub_keys(values[some].view(np.uint64), int(number), distance)
                    again = np.repeat(some, keys.shape[1])
                    yield rows(slabs[again], bits[again], keys.ravel(), values[again])

    def rows(slabs, bits, sub, values):
        near = np.bitwise_count(values.view(np.uint64) ^ _PIVOTS[0]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (slabs, bits, sub, near, values)], names=["slabs", "bits", "sub", "near", "fingerprint"]
        )

    return run


def pivot_table(values: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (rows) to each pivot (columns)."""
    return np.bitwise_count(values[:, None] ^ _PIVOTS[None, :]).astype(np.int8)


def link_in_buckets(bucket: np.ndarray, values: np.ndarray, distance: int) -> np.ndarray:
    """The position of a representative for each fingerprint, its own if nothing is linked.

    ``bucket`` numbers the buckets; in each, ``values`` come in order of their
    distance to the first pivot.
    """
    n = len(values)
    table = pivot_table(values)
    first = table[:, 0].astype(np.int16)
    label = np.arange(n)
    lag, live = 1, np.arange(n - 1)
    while True:
        live = live[live + lag < n]
        # Later positions are only farther from the pivot: what fails here fails for good.
        live = live[(bucket[live] == bucket[live + lag]) & (first[live + lag] - first[live] <= distance)]
        if not live.size:
            return label
        near = live
        for pivot in range(1, table.shape[1]):
            near = near[np.abs(table[near, pivot] - table[near + lag, pivot]) <= distance]
        near = near[np.bitwise_count(values[near] ^ values[near + lag]) <= distance]
        if near.size:
            _unite(label, near, near + lag)
        lag += 1


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def _linked(distance: int):
    """Rows in order of bucket and first pivot distance, to edges between fingerprints."""

    def edges_of(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        bucket = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
        label = link_in_buckets(bucket, values.view(np.uint64), distance)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[moved]), pa.array(values[label[moved]])], names=["src", "dst"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty((0, 3), np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            more = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            keys = np.concatenate([keys, more.astype(np.int64)])
            values = np.concatenate([values, batch.column(3).to_numpy(zero_copy_only=False)])
            # The last bucket may go on in the next batch.
            whole = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if whole:
                yield edges_of(keys[:whole], values[:whole])
                keys, values = keys[whole:], values[whole:]
        if len(values):
            yield edges_of(keys, values)

    return run


def linked_fingerprints(
    values: DataFrame, distance: int = DISTANCE, hot_bucket: int = HOT_BUCKET
) -> DataFrame:
    """Edges ``src``, ``dst`` that connect exactly the fingerprints within ``distance`` bits.

    ``values`` has one row per different ``fingerprint`` and should be a stored
    table, as it is read twice.
    """
    value = F.col("fingerprint")
    keyed = values.select("fingerprint", F.explode(F.array(*_bucket_keys(value, distance))).alias("key")).select(
        "fingerprint", "key.slabs", "key.bits"
    )
    hot = (
        keyed.groupBy("slabs", "bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > hot_bucket)
        .select("slabs", "bits", F.lit(True).alias("hot"))
    )
    dealt = (
        keyed.join(hot, ["slabs", "bits"], "left")
        .select("slabs", "bits", "fingerprint", "hot")
        .mapInArrow(_dealt(distance), "slabs int, bits bigint, sub bigint, near int, fingerprint bigint")
        .repartition("slabs", "bits", "sub")
        .sortWithinPartitions("slabs", "bits", "sub", "near", "fingerprint")
        .drop("near")
    )
    return dealt.mapInArrow(_linked(distance), "src bigint, dst bigint").distinct()


# Operators ------------------------------------------------------------------


def fingerprinted(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, fingerprint (signed long) of every document, stored."""
    return settle(
        docs.select("doc_id", text_key().alias("text_key"), fingerprint_column(F.col("text"), size).alias("fingerprint")),
        "fingerprints",
    )


def with_components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Adds ``component_id`` to rows with ``doc_id`` and ``fingerprint``: the smallest doc_id reachable.

    Null ids take part but are no smallest id; a component of null ids has null.
    Runs jobs. ``prints`` is read twice.
    """
    classes = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    roots = component_roots(linked_fingerprints(classes, distance))
    rooted = classes.join(roots, classes.fingerprint == roots.src, "left").select(
        "fingerprint", "least", F.coalesce("dst", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    # A fingerprint that many documents share is a hot key on the left only.
    return prints.join(components, "fingerprint")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row of ``docs``.

    Null and wordless texts have fingerprint zero and are linked like any other.
    Repeated rows are repeated in the result. Extra columns are ignored; an
    empty table gives an empty result.
    """
    return with_components(fingerprinted(docs, size), distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns kept.

    Of each component the document with the smallest doc_id stays (null ids
    last, then by a hash of the text); rows that repeat its id and text go.
    """
    grouped = with_components(fingerprinted(docs, size), distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), id_key().alias("id"), F.col("text_key").alias("text")))
    key, text = unused(docs, "__id"), unused(docs, "__text")
    winners = grouped.groupBy("root").agg(first.alias("first")).select(
        F.col("first.id").alias(key), F.col("first.text").alias(text)
    ).distinct()
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], id_key().alias(key), text_key().alias(text))
    return keyed.join(winners, [key, text], "left_semi").dropDuplicates([key, text]).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
