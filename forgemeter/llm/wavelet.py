"""Token ids in wavelet-matrix files.

Documents come in ascending order of doc_id, each followed by an end id, and are
cut into shards of whole documents. A shard is one compressed file that holds a
wavelet matrix over its ids: one bit-plane per bit of the largest id, highest
first, each plane in the order that stably sorts the ids by the bits above it.
With ones counted per block, a plane answers rank and select, and the matrix
answers access, count and the place of the k-th occurrence in one walk over the
planes, without unpacking the ids.

Layout of a file after decompression (numbers little-endian): the magic, then
u32 planes, u64 ids, u64 documents; per document u8 "has an id", i64 doc_id,
u64 length; per plane u64 zeros, u32 ones before each block of 512 bits, and the
bits, eight to a byte, first bit highest.

A set of files is written and read by Spark as the rows (part, shard, file) of a
Parquet table, so that a lost task leaves nothing behind and any store will do.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm.bpe import in_portions
from forgemeter.llm.byte_table import LONGEST, WIDTH, ByteTable, keys_of, padded
from forgemeter.llm.words import text_bytes, text_key

# Fixed value: marks a file of this format.
MAGIC = b"FMWMX1\0\0"
HEAD = struct.Struct("<8sIQQ")
BLOCK = 512
SHARD_IDS = 1 << 20
CACHED_WORDS = 250_000
PARTS_A_LINE = 64
# Lower-case words of ASCII letters and the Latin letters of two bytes from U+00E0 to U+017F, U+00F7 and U+0130 left out.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")


def _marked(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(characters)] = True
    return marks


IS_SPACE = _marked(bytes(i for i in range(128) if bytes([i]).isspace()))
IS_STOP = _marked(string.punctuation.encode())
IS_ALNUM = _marked(bytes(i for i in range(128) if bytes([i]).isalnum()))


def _ends_plain(buffer: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether an ASCII letter or digit, or a Latin letter of ``PLAIN``, stands right before each place."""
    last, before = buffer[ends - 1], buffer[np.maximum(ends - 2, 0)]
    latin = ((before == 0xC3) & (last >= 0xA0) & (last != 0xB7)) | ((before == 0xC4) & (last != 0xB0)) | (before == 0xC5)
    return IS_ALNUM[last] | latin


FILE_COLUMNS = "part int, shard int, start bigint, ids bigint, docs bigint, file binary"
DOC_COLUMNS = "part int, start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


# The matrix -----------------------------------------------------------------


class WaveletMatrix:
    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n = n
        self.planes = planes  # (zeros, ones before each block, packed bits)

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids, np.uint32)
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        values = ids.astype(np.uint16) if depth <= 16 else ids
        planes = []
        for bit in range(depth - 1, -1, -1):
            ones = (values >> values.dtype.type(bit)) & values.dtype.type(1) == 1
            packed = np.packbits(ones)
            planes.append((len(ids) - np.count_nonzero(ones), _ones_before(packed), packed))
            # By places, as choosing by a mask of mixed bits takes several times as long.
            values = np.concatenate([values[np.flatnonzero(~ones)], values[np.flatnonzero(ones)]])
        return cls(len(ids), planes)

    def ids(self) -> np.ndarray:
        """All ids in their order, unpacked plane by plane from the last."""
        dtype = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, dtype)
        for bit, (zeros, _, packed) in enumerate(reversed(self.planes)):
            ones = np.unpackbits(packed, count=self.n).view(bool)
            above = np.empty(self.n, dtype)
            above[np.flatnonzero(~ones)] = values[:zeros]
            above[np.flatnonzero(ones)] = values[zeros:] | dtype(1 << bit)
            values = above
        return values.astype(np.uint32)

    def _ones(self, plane: int, end: int) -> int:
        """Ones among the first ``end`` bits of a plane."""
        _, before, packed = self.planes[plane]
        block = end // BLOCK
        start = block * (BLOCK // 8)
        tail = packed[start : (end + 7) // 8]
        bits = np.unpackbits(tail, count=end - block * BLOCK)
        return int(before[block]) + int(bits.sum())

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][2][at // 8] >> (7 - at % 8) & 1)

    def _place(self, plane: int, bit: int, number: int) -> int:
        """Where the ``number``-th (from 0) bit of that kind stands in a plane."""
        _, before, packed = self.planes[plane]
        counts = before if bit else np.arange(len(before)) * BLOCK - before.astype(np.int64)
        block = int(np.searchsorted(counts, number, side="right")) - 1
        start = block * BLOCK
        bits = np.unpackbits(packed[start // 8 : (start + BLOCK) // 8], count=min(BLOCK, self.n - start))
        return start + int(np.flatnonzero(bits == bit)[number - int(counts[block])])

    def access(self, at: int) -> int:
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for plane, (zeros, _, _) in enumerate(self.planes):
            bit, ones = self._bit(plane, at), self._ones(plane, at)
            value = value << 1 | bit
            at = zeros + ones if bit else at - ones
        return value

    def _range_of(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences among the first ``end`` ids stand below the last plane."""
        low, high = 0, end
        if token >> len(self.planes):
            return 0, 0
        for plane, (zeros, _, _) in enumerate(self.planes):
            ones_low, ones_high = self._ones(plane, low), self._ones(plane, high)
            if token >> (len(self.planes) - 1 - plane) & 1:
                low, high = zeros + ones_low, zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def rank(self, token: int, end: int | None = None) -> int:
        """How often ``token`` is among the first ``end`` ids (all if not given)."""
        low, high = self._range_of(token, self.n if end is None else end)
        return high - low

    def select(self, token: int, number: int) -> int:
        """Where the ``number``-th (from 0) occurrence of ``token`` stands."""
        low, high = self._range_of(token, self.n)
        if not 0 <= number < high - low:
            raise IndexError(number)
        at = low + number
        for plane in range(len(self.planes) - 1, -1, -1):
            zeros = self.planes[plane][0]
            bit = token >> (len(self.planes) - 1 - plane) & 1
            at = self._place(plane, bit, at - zeros if bit else at)
        return at


def _ones_before(packed: np.ndarray) -> np.ndarray:
    whole = np.zeros((len(packed) + BLOCK // 8 - 1) // (BLOCK // 8) * (BLOCK // 8), np.uint8)
    whole[: len(packed)] = packed
    per_block = np.bitwise_count(whole).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")


# Files ----------------------------------------------------------------------


def shard_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    matrix = WaveletMatrix.of(ids)
    out = [
        HEAD.pack(MAGIC, len(matrix.planes), matrix.n, len(doc_ids)),
        np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array(lengths, "<u8").tobytes(),
    ]
    for zeros, before, packed in matrix.planes:
        out += [struct.pack("<Q", zeros), before.astype("<u4").tobytes(), packed.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def open_shard(file: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths, and the matrix."""
    data = zstandard.ZstdDecompressor().decompress(file)
    magic, depth, n, docs = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(data, dtype, count, at)
        at += values.nbytes
        return values

    has, doc_ids, lengths = take("u1", docs), take("<i8", docs), take("<u8", docs)
    planes = []
    for _ in range(depth):
        zeros = int(take("<u8", 1)[0])
        planes.append((zeros, take("<u4", -(-n // BLOCK) + 1), take("u1", -(-n // 8))))
    named = [int(i) if h else None for h, i in zip(has, doc_ids, strict=True)]
    return named, lengths.astype(np.int64), WaveletMatrix(n, planes)


# Word-end BPE ---------------------------------------------------------------


class IdStore:
    """Short strings and the ids of each, found many at a time."""

    def __init__(self, room: int):
        self.table = ByteTable(room)
        self.keys = np.zeros((room, WIDTH), np.uint64)
        self.stops = np.zeros(room + 1, np.int64)
        self.ids = np.zeros(4 * room, np.uint32)

    @property
    def size(self) -> int:
        return self.table.size

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Put in new strings; everything doubles when full."""
        old, new = self.size, self.size + len(keys)
        if new > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros((max(new, old), WIDTH), np.uint64)])
            self.stops = np.concatenate([self.stops, np.zeros(max(new, old), np.int64)])
        self.keys[old:new] = keys
        self.stops[old + 1 : new + 1] = self.stops[old] + np.cumsum(counts)
        used = int(self.stops[new])
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(used, len(self.ids)), np.uint32)])
        self.ids[used - len(ids) : used] = ids
        if new > self.table.room:
            self.table = ByteTable(2 * new)
            self.table.add(self.keys[:new], np.arange(new, dtype=np.int32))
        else:
            self.table.add(keys, np.arange(old, new, dtype=np.int32))

    def of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of the entries, and the ids one entry after the other."""
        starts = self.stops[entries]
        counts = self.stops[entries + 1] - starts
        return counts, self.ids[_runs(starts, counts)]


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every run, one run after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


class WordEncoder:
    """A ``tokenizers`` file whose pre-tokenizer drops white space: words are encoded alone and kept.

    The string of a special token in a text is that token, as the library has it, or with ``as_text`` ordinary text.

    The words of a portion are cut, lowered and looked up as arrays; the library
    sees those that are new to the worker. Of two halves of what it knows, the
    older goes when the younger holds ``CACHED_WORDS``, so words met lately stay.
    """

    def __init__(self, path: str, as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = as_text
        # Strings without white space, found before letters are lowered.
        added = [] if as_text else self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode() for token in added]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.young, self.old = IdStore(CACHED_WORDS), IdStore(1)

    def _encoded(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of different parts, as the library encodes each alone; many in one line."""
        # Letters of one script are one word to the pre-tokenizer, and only its last id ends a word.
        plain, other = [], []
        for number, part in enumerate(parts):
            (plain if part.isalpha() or PLAIN.fullmatch(part) else other).append(number)
        counts = np.zeros(len(parts), np.int64)
        ids: list[np.ndarray] = []
        if plain:
            texts = [text for _, text in self._lines(parts, plain)]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids.append(np.array([number for one in encoded for number in one.ids], np.uint32))
            counts[plain] = np.diff(np.flatnonzero(self.ends_word[ids[0]]) + 1, prepend=0)
        # For the others offsets tell whose an id is.
        for line, text in self._lines(parts, other):
            one = self.tokenizer.encode_batch([text], add_special_tokens=False)[0]
            ends = np.cumsum([len(parts[number].decode()) + 1 for number in line])
            owner = np.searchsorted(ends, [start for start, _ in one.offsets], side="right")
            counts[line] = np.bincount(owner, minlength=len(line))
            ids.append(np.array(one.ids, np.uint32))
        order = np.array(plain + other, np.int64)
        starts = np.zeros(len(parts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        return counts, flat[_runs(starts, counts)]

    @staticmethod
    def _lines(parts: list[bytes], which: list[int]):
        for at in range(0, len(which), PARTS_A_LINE):
            line = which[at : at + PARTS_A_LINE]
            yield line, b" ".join([parts[number] for number in line]).decode()

    def _entries(self, keys: np.ndarray, slices) -> np.ndarray:
        """Entries in the young half of the strings with these keys; those not there are brought in."""
        found = self.young.table.find(keys)
        missed = np.flatnonzero(found < 0)
        if len(missed):
            before = self.old.table.find(keys[missed])
            again = np.unique(before[before >= 0])
            if len(again):
                self.young.add(self.old.keys[again], *self.old.of(again))
            unseen = missed[before < 0]
            first = dict(zip(slices(unseen), unseen.tolist(), strict=True))
            if first:
                self.young.add(keys[list(first.values())], *self._encoded(list(first)))
            found[missed] = self.young.table.find(keys[missed])
        return found

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if self.young.size > CACHED_WORDS:
            self.young, self.old = IdStore(CACHED_WORDS), self.young
        data = b" ".join(texts) + b" "
        lowered = data.lower()
        buffer = padded(lowered)
        inside = np.concatenate([[False], ~IS_SPACE[buffer[: len(data)]]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edges[::2], edges[1::2]
        # Capitals make no special token, so a word that lowering would turn into one stays as it is.
        whole = np.zeros(len(starts), bool)
        for special in self.special:
            at = lowered.find(special)
            while at >= 0:
                whole[np.searchsorted(starts, at, side="right") - 1] = True
                at = lowered.find(special, at + 1)
        # A run of ASCII punctuation at the end, after a letter or digit, is a word of its own anyway.
        cores = stops.copy()
        cutting = np.flatnonzero(~whole & IS_STOP[buffer[stops - 1]])
        while len(cutting):
            cores[cutting] -= 1
            cutting = cutting[(cores[cutting] > starts[cutting]) & IS_STOP[buffer[cores[cutting] - 1]]]
        cut = (cores > starts) & (cores < stops) & _ends_plain(buffer, cores)
        at = np.concatenate([starts, cores[cut]])
        end = np.concatenate([np.where(cut, cores, stops), stops[cut]])
        order = np.argsort(at, kind="stable")
        at, end, whole = at[order], end[order], np.concatenate([whole, np.zeros(int(cut.sum()), bool)])[order]

        apart = whole | (end - at > LONGEST)
        short, rest = np.flatnonzero(~apart), np.flatnonzero(apart)

        def slices(which: np.ndarray) -> list[bytes]:
            own = short[which]
            return [lowered[a:b] for a, b in zip(at[own].tolist(), end[own].tolist(), strict=True)]

        entries = self._entries(keys_of(buffer, at[short], end[short] - at[short]), slices)
        starts_of, counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        pool = self.young.ids
        starts_of[short] = self.young.stops[entries]
        counts[short] = self.young.stops[entries + 1] - starts_of[short]
        if len(rest):
            # Long words, and words with special tokens, are encoded anew in each portion.
            words = [(data if w else lowered)[a:b] for w, a, b in zip(whole[rest], at[rest], end[rest], strict=True)]
            number = {word: i for i, word in enumerate(dict.fromkeys(words))}
            each, ids = self._encoded(list(number))
            which = np.array([number[word] for word in words])
            used = int(self.young.stops[self.young.size])
            pool = np.concatenate([pool[:used], ids])
            starts_of[rest] = used + (np.cumsum(each) - each)[which]
            counts[rest] = each[which]
        flat = pool[_runs(starts_of, counts)].astype("<u4").tobytes()
        # How many ids come before the end of each text.
        ends = np.cumsum([len(text) + 1 for text in texts])
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(at, ends)].tolist()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *upto[:-1]], upto, strict=True)]


@lru_cache(maxsize=2)
def word_encoder(path: str, as_text: bool = True) -> WordEncoder:
    return WordEncoder(path, as_text)


# Operators ------------------------------------------------------------------


def _shards(path: str, end_id: int, shard_ids: int, as_text: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(path, as_text)
        shard, start = 0, 0
        names: list[int | None] = []
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, start, names, held
            lengths = [len(ids) // 4 for ids in held]
            ids = np.frombuffer(b"".join(held), "<u4")
            values = [part, shard, start, len(ids), len(names), shard_file(names, lengths, ids)]
            shard, start, names, held = shard + 1, start + len(ids), [], []
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = ["part", "shard", "start", "ids", "docs", "file"]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=columns
            )

        part, size = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            rows = list(zip(batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True))
            for portion in in_portions(rows, lambda row: len(row[1])):
                for (name, _), ids in zip(portion, own.encode_batch([data for _, data in portion]), strict=True):
                    names.append(name)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= shard_ids:
                        yield flush()
                        size = 0
        if names:
            yield flush()

    return run


def write_shards(
    docs: DataFrame, out: str, path: str, end_id: int, shard_ids: int = SHARD_IDS, as_text: bool = True
) -> None:
    """Encode every document, append ``end_id``, and write the shards to the table ``out``.

    Documents are range-partitioned by doc_id (nulls last; equal ids in order of
    a hash of the text) and ordered in each range; a shard ends with the document
    that fills it. Strings of special tokens are ordinary text unless ``as_text``
    is false; then they are the library's ids. A null text is empty, its ids the end id alone. Repeated rows
    are repeated; extra columns are ignored; an empty table gives an empty one.
    """
    order = [F.col("doc_id").asc_nulls_last(), text_key().asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _shards(path, end_id, shard_ids, as_text), FILE_COLUMNS
    ).write.parquet(out)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, start, file in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            names, lengths, matrix = open_shard(file)
            data = matrix.ids().astype("<u4").tobytes()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(names), part, np.int32)),
                    pa.array(starts + start),
                    pa.array(names, pa.int64()),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ],
                names=["part", "start", "doc_id", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards' contents.

    ``start`` is the number of ids in all documents before.
    """
    files = spark.read.schema(FILE_COLUMNS).parquet(out)
    documents = files.select("part", "start", "file").mapInArrow(_documents, DOC_COLUMNS)
    # One row per range of the write: at most as many as its shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids")).select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset")
    )
    return documents.join(parts, "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
