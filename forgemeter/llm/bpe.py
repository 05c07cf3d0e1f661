"""Byte-level BPE encoding and decoding with segment trees.

A text is cut by the split pattern; each piece is merged on its own, always the
adjacent pair of lowest rank, leftmost first. A segment tree over the byte
positions of a piece keeps the smallest (pair rank, position) at its root. A
merge kills one leaf and renews the two of its live neighbours; each of these
point updates climbs one path, so a piece of n bytes costs O(n log n), however
long it is. Short pieces are merged many at a time, one tree per row of an array
and all rows in step; long ones one by one.

Words repeat, so encoded chunks are kept in a bounded cache per worker.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.words import text_bytes

ID_BITS = 20
DEAD = np.int64(2**62)
LONGEST_IN_STEP = 63
CACHED_CHUNKS = 250_000
BYTES_AT_ONCE = 1_000_000
_POSITION_BITS = 6


class Codec:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        # A space with white space on both sides is no sure border between pieces.
        self.unsure = regex.compile(r"\s \s|\s \Z").search
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("every single byte needs a rank")
        pairs = [
            (ranks[token[:cut]] << ID_BITS | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.sort()
        self.pair_keys = np.array([key for key, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs] or [0], np.int64)
        self.after_space: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    # Merging ----------------------------------------------------------------

    def merge_long(self, data: bytes) -> list[int]:
        """One piece, one tree."""
        n, ranks = len(data), self.ranks
        if n < 2:
            return [ranks[data]] if n else []
        shift = n.bit_length()
        low, dead = (1 << shift) - 1, 1 << 62
        leaves = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [dead] * (2 * leaves)
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                tree[leaves + i] = rank << shift | i
        for node in range(leaves - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        following = list(range(1, n + 2))
        before = list(range(-1, n))

        def put(leaf: int, value: int) -> None:
            node = leaves + leaf
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                best = a if a < b else b
                if tree[node] == best:
                    return
                tree[node] = best
                node >>= 1

        while (root := tree[1]) < dead:
            at = root & low
            gone = following[at]
            end = following[gone]
            following[at] = end
            before[end] = at
            if gone < n - 1:
                put(gone, dead)
            rank = ranks.get(data[at : following[end]]) if end < n else None
            put(at, dead if rank is None else rank << shift | at)
            left = before[at]
            if left >= 0:
                rank = ranks.get(data[left:end])
                put(left, dead if rank is None else rank << shift | left)
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at : following[at]]])
            at = following[at]
        return out

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left < 0) | (right < 0), -1, left << ID_BITS | right)
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[place] == key) & (key >= 0), self.pair_ranks[place], -1)

    def merge_in_step(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Pieces shorter than ``leaves`` bytes, one tree per row; ids as little-endian 32-bit numbers."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(piece.ljust(leaves, b"\0") for piece in pieces), np.uint8).reshape(n, leaves)
        place = np.arange(leaves)
        live = place[None, :] < lengths[:, None]
        # The last column is never a token: "no neighbour" points there.
        tokens = np.where(live, self.of_byte[raw], -1).ravel()
        following = np.tile(np.minimum(place + 1, leaves - 1), n)
        before = np.tile(np.where(place == 0, leaves - 1, place - 1), n)
        live = live.ravel()

        rank = self._pair_rank(tokens[:-1], tokens[1:])
        leaf = np.full(n * leaves, DEAD)
        leaf[:-1] = np.where(rank < 0, DEAD, rank << _POSITION_BITS | (np.arange(n * leaves - 1) % leaves))
        tree = np.full((n, 2 * leaves), DEAD)
        tree[:, leaves:] = leaf.reshape(n, leaves)
        width = leaves
        while width > 1:
            tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
            width //= 2
        tree = tree.ravel()

        rows = np.arange(n)
        while True:
            root = tree[rows * (2 * leaves) + 1]
            rows, root = rows[root < DEAD], root[root < DEAD]
            if not rows.size:
                break
            base, top = rows * leaves, rows * (2 * leaves)
            at = root & ((1 << _POSITION_BITS) - 1)
            gone = following[base + at]
            end = following[base + gone]
            left = before[base + at]
            merged = root >> _POSITION_BITS
            tokens[base + at] = merged
            tokens[base + gone] = -1
            live[base + gone] = False
            following[base + at] = end
            before[base + end] = at
            before[base + leaves - 1] = leaves - 1
            tree[top + leaves + gone] = DEAD
            for place, a, b in (
                (at, merged, tokens[base + end]),
                (left, tokens[base + left], merged),
            ):
                rank = self._pair_rank(a, b)
                tree[top + leaves + place] = np.where(rank < 0, DEAD, rank << _POSITION_BITS | place)
            nodes = np.concatenate([leaves + at, leaves + gone, leaves + left])
            top = np.concatenate([top, top, top])
            while nodes[0] > 1:
                nodes = nodes >> 1
                tree[top + nodes] = np.minimum(tree[top + 2 * nodes], tree[top + 2 * nodes + 1])
        counts = np.concatenate([[0], np.cumsum(live.reshape(n, leaves).sum(axis=1))]) * 4
        ids = tokens[live].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(counts.tolist(), counts[1:].tolist(), strict=False)]

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of unseen pieces into the cache."""
        classes: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(data) > LONGEST_IN_STEP:
                self.known[piece] = np.array(self.merge_long(data), "<u4").tobytes()
            else:
                classes[1 << len(data).bit_length()].append((piece, data))
        for leaves, members in classes.items():
            encoded = self.merge_in_step([data for _, data in members], leaves)
            self.known.update(zip((piece for piece, _ in members), encoded, strict=True))

    # Texts ------------------------------------------------------------------

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = []
        for text in texts:
            if self.unsure(text):
                cut.append((text, []))
            else:
                parts = text.split(" ")
                cut.append((parts[0], parts[1:]))
        after_space, known = self.after_space, self.known
        unseen: set[str] = set()
        for _, parts in cut:
            unseen.update(parts)
        new = [(part, self.pieces(" " + part)) for part in unseen if part not in after_space]
        heads = [self.pieces(head) for head, _ in cut]
        wanted = {piece for _, pieces in new for piece in pieces}
        wanted.update(piece for head in heads for piece in head)
        self._learn({piece for piece in wanted if piece not in known})
        for part, pieces in new:
            after_space[part] = b"".join([known[piece] for piece in pieces])
        out = [
            b"".join([known[piece] for piece in head]) + b"".join([after_space[part] for part in parts])
            for head, (_, parts) in zip(heads, cut, strict=True)
        ]
        if len(after_space) > CACHED_CHUNKS:
            after_space.clear()
        if len(known) > CACHED_CHUNKS:
            known.clear()
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, once per worker."""
    return Codec(read_ranks(path), pattern)


class Decoder:
    """The bytes of all tokens in one array, and where each starts."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each id's end among them."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)], ends


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def in_portions(values: list, size) -> list[list]:
    """Consecutive portions of about ``BYTES_AT_ONCE`` by ``size``, so that what a step holds is bounded."""
    portions, room = [], 0
    for value in values:
        if not portions or room <= 0:
            portions.append([])
            room = BYTES_AT_ONCE
        portions[-1].append(value)
        room -= size(value)
    return portions


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in encoded], dtype=np.int64)])
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _decoded(lists: pa.Array, own: Decoder) -> pa.Array:
    values = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    data, ends = own.decode(values)
    stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])]
    raw = data.tobytes()
    return pa.array([raw[a:b] for a, b in zip(stops.tolist(), stops[1:].tolist(), strict=False)], pa.binary())


def _portions(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``BYTES_AT_ONCE`` each."""
    at = 0
    for portion in in_portions(pc.fill_null(sizes, 0).to_pylist(), int):
        yield batch.slice(at, len(portion))
        at += len(portion)


def _encoded(path: str, pattern: str, decode: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, back = codec(path, pattern), decoder(path) if decode else None
        for batch in batches:
            for rows in _portions(batch, pc.binary_length(batch.column(1))):
                ids = _id_lists(own.encode_batch([data.decode() for data in text_bytes(rows.column(1))]))
                columns = [rows.column(0), ids] + ([_decoded(ids, back)] if decode else [])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    return run


def _back(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            for rows in _portions(batch, pc.list_value_length(batch.column(1))):
                columns = [rows.column(0), _decoded(rows.column(1), own)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "decoded"])

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids`` of every row of ``docs``.

    Null and empty texts have an empty list; repeated rows are repeated; extra
    columns are ignored; an empty table gives an empty result. Special tokens'
    strings are ordinary text.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(_encoded(path, pattern, False), schema)


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``decoded``, the bytes that ``ids`` stand for; null ids stand for none."""
    schema = f"doc_id {dict(coded.dtypes)['doc_id']}, decoded binary"
    return coded.select("doc_id", "ids").mapInArrow(_back(path), schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256.

    Encoding and decoding of a portion of documents follow each other in one
    worker. Nulls, repeats and empty tables as in ``encode_documents``.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>, decoded binary"
    return docs.select("doc_id", "text").mapInArrow(_encoded(path, pattern, True), schema).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
