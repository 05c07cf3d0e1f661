"""Token counts by a map-side two-tier lookup of pre-token lengths.

A byte-level BPE encodes each pre-token of a text by itself, so a text has as
many tokens as its pre-tokens have together, and what a pre-token has is looked
up. The first tier is a compact table of the lengths of frequent pre-tokens,
broadcast to all tasks; its size is fixed by ``FREQUENT``. What is not in it goes
to the second tier, a cache that each worker keeps across portions and tasks,
and what is not there is encoded by the library. Nothing but the tier is
shared: the documents need no shuffle, and neither do their pre-tokens.

Which pre-tokens the first tier holds comes from a sample of about
``SAMPLE_ROWS`` documents and decides only how fast a count is found, never what
it is.

Texts are cut into pre-tokens as arrays, a portion at a time: letters, numbers,
white space and the rest are told apart by the library's own expressions, and
the rules of its pattern are comparisons of neighbouring characters.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.bpe import in_portions
from forgemeter.llm.byte_table import LONGEST, ByteTable, keys_of, padded
from forgemeter.llm.words import text_bytes

FREQUENT = 1 << 17
SAMPLE_ROWS = 4_096
CACHED = 400_000
PARTS_A_LINE = 500
LIMIT = 512

OTHER, LETTER, NUMBER, SPACE, END = range(5)

COLUMNS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


# Pre-tokens -----------------------------------------------------------------


def character_kinds() -> np.ndarray:
    """Per code point: letter, number, white space or other, as the library's expressions have it."""
    from tokenizers import Regex, normalizers

    points = np.delete(np.arange(0x110000), np.s_[0xD800:0xE000])
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    kinds = np.zeros(0x110000, np.uint8)
    for kind, expression in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        marked = np.zeros(len(points), bool)
        for mark in "#$":
            given = normalizers.Replace(Regex(expression), mark).normalize_str(text)
            marked |= np.frombuffer(given.encode("utf-32-le"), "<u4") != points
        kinds[points[marked]] = kind
    return kinds


def pre_tokens(texts: list[str], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all pre-tokens in order: first character, length in characters, number of the text.

    Characters are counted in the texts with one character between two of them.
    """
    data = "\0".join(texts) + "\0"
    points = np.frombuffer(data.encode("utf-32-le"), "<u4")
    kind = kinds[points]
    stops = np.cumsum(np.array([len(t) + 1 for t in texts])) - 1
    kind[stops] = END
    before = np.concatenate([[END], kind[:-1]])
    starts = kind != before
    # The last white space of a run goes with what follows if it is a space, else it stands alone.
    after_space = np.flatnonzero((before == SPACE) & (kind != SPACE) & (kind != END))
    starts[after_space - 1] = True
    spaced = after_space[points[after_space - 1] == 0x20]
    starts[spaced] = False
    # An apostrophe that begins a pre-token takes s, t, m, d, re, ve or ll with it.
    quote = np.flatnonzero((points == 0x27) & (before != OTHER) & starts)
    if len(quote):
        wide = np.concatenate([points, [0, 0]])
        one, two = wide[quote + 1], wide[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        taken = np.where(short, 2, np.where(long, 3, 0))
        quote, taken = quote[taken > 0], taken[taken > 0]
        starts[quote + 1] = False
        starts[quote + taken] = True
    at = np.flatnonzero(starts)
    size = np.diff(np.append(at, len(points)))
    inside = kind[at] != END
    at, size = at[inside], size[inside]
    return at, size, np.searchsorted(stops, at)


# Lengths --------------------------------------------------------------------


class Lengths:
    """How many tokens the library makes of a pre-token; remembers what it met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        cut = given["pre_tokenizer"] or {}
        if (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) != ("ByteLevel", True, False) or given[
            "normalizer"
        ]:
            raise ValueError(f"{path}: not a byte-level vocabulary with the common pattern")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[number for token, number in vocabulary.items() if token.startswith("Ġ")]] = True
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def parts(self, text: str) -> tuple[list[str], int]:
        """The text between strings of special tokens, and their number; the library looks for them first."""
        parts = [text]
        for special in self.special:
            if special in text:
                parts = [p for part in parts for p in part.split(special)]
        return parts, len(parts) - 1

    def of(self, pieces: list[bytes], plain: list[bool]) -> list[int]:
        """Lengths of pre-tokens; ``plain`` ones are a space and letters.

        What was met lately stays: of two halves of the cache the older goes.
        """
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new: dict[bytes, bool] = {}
        for piece, simple in zip(pieces, plain, strict=True):
            if piece not in young:
                if piece in old:
                    young[piece] = old[piece]
                else:
                    new[piece] = simple
        self._learn([p for p, simple in new.items() if simple], [p for p, simple in new.items() if not simple])
        return [young[piece] for piece in pieces]

    def _learn(self, plain: list[bytes], other: list[bytes]) -> None:
        encode = self.tokenizer.encode_batch_fast
        # Words behind spaces stay apart in one line; a token that begins with the space begins a word.
        for at in range(0, len(plain), PARTS_A_LINE):
            line = plain[at : at + PARTS_A_LINE]
            ids = encode([b"".join(line).decode()], add_special_tokens=False)[0].ids
            begins = np.flatnonzero(self.begins[ids])
            self.young.update(zip(line, np.diff(np.append(begins, len(ids))).tolist(), strict=True))
        for at in range(0, len(other), PARTS_A_LINE):
            line = other[at : at + PARTS_A_LINE]
            found = encode([piece.decode() for piece in line], add_special_tokens=False)
            self.young.update((piece, len(one.ids)) for piece, one in zip(line, found, strict=True))


@lru_cache(maxsize=2)
def lengths_of(path: str) -> Lengths:
    return Lengths(path)


class Portion:
    """The pre-tokens of some texts as bytes in one buffer."""

    def __init__(self, texts: list[bytes], own: Lengths, kinds: np.ndarray):
        parts, owners, self.specials = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found, self.specials[i] = own.parts(text.decode())
            parts += found
            owners += [i] * len(found)
        at, size, part = pre_tokens(parts, kinds)
        self.owner = np.array(owners, np.int64)[part]
        self.data = ("\0".join(parts) + "\0").encode()
        self.buffer = padded(self.data)
        if len(self.data) == sum(map(len, parts)) + len(parts):
            self.starts, stops = at, at + size
        else:
            lead = np.flatnonzero((self.buffer[: len(self.data)] & 0xC0) != 0x80)
            lead = np.append(lead, len(self.data))
            self.starts, stops = lead[at], lead[at + size]
        self.lengths = stops - self.starts
        first, second = self.buffer[self.starts], self.buffer[self.starts + 1]
        ascii_letter = ((second | 32) >= 97) & ((second | 32) <= 122)
        self.plain = (first == 0x20) & (self.lengths > 1) & ascii_letter

    def pieces(self, which: np.ndarray) -> list[bytes]:
        stops = self.starts + self.lengths
        data = self.data
        return [data[a:b] for a, b in zip(self.starts[which].tolist(), stops[which].tolist(), strict=True)]


def count_tokens(texts: list[bytes], own: Lengths, kinds: np.ndarray, frequent: ByteTable) -> np.ndarray:
    portion = Portion(texts, own, kinds)
    found = np.full(len(portion.starts), -1, np.int32)
    short = np.flatnonzero(portion.lengths <= LONGEST)
    found[short] = frequent.find(keys_of(portion.buffer, portion.starts[short], portion.lengths[short]))
    missed = np.flatnonzero(found < 0)
    found[missed] = own.of(portion.pieces(missed), portion.plain[missed].tolist())
    counts = np.bincount(portion.owner, weights=found, minlength=len(texts)).astype(np.int64)
    return counts + portion.specials


# Operators ------------------------------------------------------------------


def _texts(column: pa.Array) -> list[list[bytes]]:
    return in_portions(text_bytes(column), len)


def _sampled(path: str, kinds):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lengths_of(path)
        for batch in batches:
            for texts in _texts(batch.column(0)):
                portion = Portion(texts, own, kinds.value)
                pieces = pa.array(portion.pieces(np.flatnonzero(portion.lengths <= LONGEST)), pa.binary())
                counts = pieces.value_counts()
                yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], names=["piece", "n"])

    return run


def frequent_pieces(docs: DataFrame, path: str, kinds, rows: int = SAMPLE_ROWS, most: int = FREQUENT) -> list[bytes]:
    """The most frequent pre-tokens of a sample of about ``rows`` documents, ``most`` at the most. Runs jobs."""
    total = docs.count()
    if not total:
        return []
    sample = docs.select("text").sample(min(1.0, rows / total), seed=0)
    counted = sample.mapInArrow(_sampled(path, kinds), "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return [bytes(row["piece"]) for row in counted.orderBy(F.col("n").desc(), "piece").limit(most).collect()]


def table_of(pieces: list[bytes], path: str) -> ByteTable:
    """Pre-tokens of up to ``LONGEST`` bytes and their lengths."""
    table = ByteTable(max(1, len(pieces)))
    if pieces:
        own = lengths_of(path)
        lengths = np.array([len(p) for p in pieces])
        data = padded(b"".join(pieces))
        values = [n for at in range(0, len(pieces), CACHED) for n in own.of(pieces[at : at + CACHED], [False] * len(pieces))]
        table.add(keys_of(data, np.cumsum(lengths) - lengths, lengths), np.array(values, np.int32))
    return table


def _counted(path: str, limit: int, shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lengths_of(path)
        kinds, frequent = shared.value
        for batch in batches:
            texts = text_bytes(batch.column(1))
            counts = [count_tokens(portion, own, kinds, frequent) for portion in in_portions(texts, len)]
            tokens = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=[part.split()[0] for part in COLUMNS.split(", ")],
            )

    return run


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, sample_rows: int = SAMPLE_ROWS, frequent: int = FREQUENT
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit per document, as the library's encoding without added tokens.

    ``path`` is a byte-level vocabulary file of the tokenizers library with its
    common pattern; strings of special tokens inside texts are those tokens, as
    by its default. A null text is empty: no bytes, no tokens. Repeated rows are
    counted each, extra columns are ignored, an empty table gives no row. The
    file must be at ``path`` on every worker. Runs jobs on the sample.
    """
    context = docs.sparkSession.sparkContext
    kinds = character_kinds()
    pieces = frequent_pieces(docs, path, context.broadcast(kinds), sample_rows, frequent)
    shared = context.broadcast((kinds, table_of(pieces, path)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_counted(path, limit, shared), COLUMNS)
