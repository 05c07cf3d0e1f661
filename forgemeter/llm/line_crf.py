"""Quality rules: base counts, then line labelling by a linear-chain conditional random field.

Each line of a document is content or boilerplate. Binary features of a line
(symbols, bars, capitals, exclamations, repetition, length, repeats of earlier
lines) give the node scores of a two-state chain, neighbouring lines its edge
scores; Viterbi decoding marks the lines, and a document is kept if at least
``SHARE`` of its words stand in content lines. The weights are trained by
gradient ascent on the small labelled table below, the same on every run.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.words import text_bytes, unused

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
FEWEST_WORDS = 20
REPEAT_WINDOW = 8
MOST_REPEATED_PERCENT = 30

SHARE = 0.5
BOILERPLATE, CONTENT = 0, 1

FEATURES = (
    "always", "one or two words", "three to nine words", "ten or more words", "symbols on words",
    "bars between words", "capitals", "exclamations", "few different words", "repeats a line", "no full stop or comma",
)

# The labelled table: documents as lines of (label, text), content or boilerplate.
LABELLED = (
    (
        (CONTENT, "The river rises in the hills and, after a long bend, reaches the plain below the old town."),
        (CONTENT, "Farmers on both banks have used its water for their fields for many hundred years."),
        (CONTENT, "It floods in spring."),
        (CONTENT, "Most houses near the water stand on stone feet, which keeps the lower rooms dry in a wet year."),
    ),
    (
        (BOILERPLATE, "Home | News | Sport | Weather | Contact | About"),
        (CONTENT, "A new bridge was opened on Monday, and the first cars crossed it in the early morning."),
        (CONTENT, "The mayor spoke of a good day for the town and its people, who had waited long for it."),
        (BOILERPLATE, "Login | Register | Terms | Privacy | Imprint | Help"),
    ),
    (
        (BOILERPLATE, "BUY!! NOW!! THE!! BEST!! OFFER!! OF!! THE!! YEAR!! ENDS!! TODAY!!"),
        (BOILERPLATE, "FREE!! GIFT!! FOR!! EVERY!! ORDER!! CLICK!! HERE!! AND!! SAVE!! BIG!!"),
        (BOILERPLATE, "ONLY THIS WEEK WE GIVE YOU THE BEST PRICE IN TOWN"),
    ),
    (
        (CONTENT, "He wrote the letter in the evening and sent it the next day from the small office."),
        (BOILERPLATE, "when$$$ the### rain%%% came&&& they*** went### home%%% and$$$ slept### well&&&"),
        (BOILERPLATE, "some&&& more*** of### the%%% same$$$ with### marks&&& on*** every%%% word$$$"),
        (CONTENT, "No answer ever came, though he asked for it twice."),
    ),
    (
        (BOILERPLATE, "offer offer offer offer offer offer offer offer offer offer offer offer"),
        (BOILERPLATE, "buy cheap buy cheap buy cheap buy cheap buy cheap buy cheap buy cheap"),
        (BOILERPLATE, "offer offer offer offer offer offer offer offer offer offer offer offer"),
        (BOILERPLATE, "offer offer offer offer offer offer offer offer offer offer offer offer"),
    ),
    (
        (CONTENT, "Licensed under an open licence"),
        (CONTENT, "The committee met in the large hall, heard three reports and agreed on a plan for the winter."),
        (CONTENT, "Two members were absent, one of them ill."),
        (CONTENT, "Write to 12 High Street or call 555 0100 for a copy of the minutes, which are free."),
        (CONTENT, "Thanks, all."),
    ),
    (
        (BOILERPLATE, "Menu"),
        (BOILERPLATE, "Share | Print | Mail"),
        (BOILERPLATE, "Menu"),
        (BOILERPLATE, "Share | Print | Mail"),
        (CONTENT, "The museum shows tools, boats and nets from the time when the whole coast lived on fish."),
        (CONTENT, "Children go in free, and on Sundays so does everybody else."),
    ),
    (
        (BOILERPLATE, "The%%% rain,&&& he*** said.### Would$$$ come,%%% and&&& so*** it### did.&&&"),
        (BOILERPLATE, "They$$$ waited.&&& Nobody,### not%%% one,*** went.&&& All$$$ stayed,%%% of### course.***"),
    ),
    (
        (CONTENT, "In the south the harvest was good, in the north it was not."),
        (BOILERPLATE, "Home, | Sport. | Weather, | Travel | Books. | Films, | Contact."),
        (BOILERPLATE, "Mail. | Print, | Share | Top, | Next. | Last"),
    ),
    (
        (BOILERPLATE, "COME.!! BUY,!! NOW!! BIG!! SALE,!! ALL!! WEEK.!!"),
        (BOILERPLATE, "DO NOT MISS THIS, IT IS THE BEST, AND THE LAST."),
        (BOILERPLATE, "good, good, good, good, good, good, good, good, good."),
        (BOILERPLATE, "cheap. cheap. cheap. cheap. cheap. cheap. cheap. cheap. cheap."),
    ),
    (
        (CONTENT, "Copyright and licence"),
        (CONTENT, "Names of the members of the board for the next two years"),
        (CONTENT, "The list was read out, and there were no questions."),
        (CONTENT, "The list was read out, and there were no questions."),
        (CONTENT, "End of the report"),
    ),
    (
        (CONTENT, "Chapter Two"),
        (CONTENT, "In the morning they found the door open, the lamp burning, and nobody in the house."),
        (CONTENT, "Nobody said a word."),
        (CONTENT, "They looked in the barn, along the lane and down at the mill before they went back to wait"),
    ),
)


# Base counts ----------------------------------------------------------------


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that stand in a run of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.uint64, len(words))
    scrambled = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    scrambled ^= scrambled >> np.uint64(29)
    scrambled *= np.uint64(0xBF58476D1CE4E5B9)
    scrambled ^= scrambled >> np.uint64(32)
    hashes = np.zeros(n, np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0x100000001B3) + scrambled[i : i + n]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[window:] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


# Features -------------------------------------------------------------------


def line_features(line: str, seen: bool) -> list[int]:
    """The numbers of the features that hold for a line with words; ``seen``: it repeats an earlier one."""
    words = line.split()
    n = len(words)
    found = [0, 1 if n < 3 else 2 if n < 10 else 3]
    if sum(map(line.count, "#*$%&<>")) >= 0.5 * n:
        found.append(4)
    if line.count("|") >= 0.25 * n:
        found.append(5)
    if n > 2 and sum(map(str.isupper, words)) >= 0.7 * n:
        found.append(6)
    if line.count("!!") >= 0.3 * n:
        found.append(7)
    if n >= 8 and len(set(words)) <= 0.4 * n:
        found.append(8)
    if seen:
        found.append(9)
    if not line.rstrip().endswith((".", ",", "!", "?", ";", ":")) and "," not in line and ". " not in line:
        found.append(10)
    return found


# The field ------------------------------------------------------------------


class Field:
    """Weights: ``node`` (features, 2) and ``edge`` (2, 2)."""

    def __init__(self, node: np.ndarray, edge: np.ndarray):
        self.node, self.edge = node, edge

    def scores(self, lines: list[list[int]]) -> np.ndarray:
        return np.array([self.node[found].sum(axis=0) for found in lines])

    def gradient(self, lines: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of one labelled chain, by forward and backward sums."""
        score = self.scores(lines)
        n = len(lines)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = score[0]
        for i in range(1, n):
            ahead[i] = score[i] + np.logaddexp.reduce(ahead[i - 1][:, None] + self.edge, axis=0)
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp.reduce(self.edge + (score[i + 1] + behind[i + 1])[None, :], axis=1)
        whole = np.logaddexp.reduce(ahead[-1])
        node, edge = np.zeros_like(self.node), np.zeros_like(self.edge)
        for i, found in enumerate(lines):
            own = np.eye(2)[labels[i]] - np.exp(ahead[i] + behind[i] - whole)
            node[found] += own
            if i:
                both = ahead[i - 1][:, None] + self.edge + (score[i] + behind[i])[None, :] - whole
                edge -= np.exp(both)
                edge[labels[i - 1], labels[i]] += 1
        return node, edge

    def decode(self, lines: list[list[int]]) -> list[int]:
        """The best labels (Viterbi); ties go to content."""
        node, ((same0, to1), (to0, same1)) = self._rows(), self.edge.tolist()
        best0 = best1 = 0.0
        back: list[tuple[int, int]] = []
        for i, found in enumerate(lines):
            own0 = own1 = 0.0
            for feature in found:
                own0 += node[feature][0]
                own1 += node[feature][1]
            if i:
                from0, from1 = best0 + same0, best1 + to0
                into0, into1 = best0 + to1, best1 + same1
                back.append((0 if from0 > from1 else 1, 0 if into0 > into1 else 1))
                best0, best1 = max(from0, from1), max(into0, into1)
            best0, best1 = best0 + own0, best1 + own1
        if not lines:
            return []
        labels = [0 if best0 > best1 else 1]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def _rows(self) -> list[list[float]]:
        return self.node.tolist()


@lru_cache(maxsize=1)
def trained(rounds: int = 500, rate: float = 0.5, decay: float = 0.002) -> Field:
    """The field fitted to the labelled table."""
    field = Field(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    chains = []
    for document in LABELLED:
        seen: set[str] = set()
        features = []
        for _, text in document:
            features.append(line_features(text, text in seen))
            seen.add(text)
        chains.append((features, [label for label, _ in document]))
    for _ in range(rounds):
        steps = [field.gradient(*chain) for chain in chains]
        field.node += rate * (sum(node for node, _ in steps) / len(chains) - decay * field.node)
        field.edge += rate * (sum(edge for _, edge in steps) / len(chains) - decay * field.edge)
    return field


# Operator -------------------------------------------------------------------


def judge(data: bytes, field: Field) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words in content lines."""
    words = data.split()
    if not words:
        return 0, 0, 0, 0, 0, 0
    # Bytes that continue a character are 0b10xxxxxx.
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(np.count_nonzero((joined & 0xC0) != 0x80))
    seen: set[bytes] = set()
    lines, sizes, repeats = [], [], 0
    for line in data.split(b"\n"):
        size = len(line.split())
        if size:
            again = line in seen
            repeats += again
            seen.add(line)
            lines.append(line_features(line.decode(), again))
            sizes.append(size)
    content = sum(size for size, label in zip(sizes, field.decode(lines), strict=True) if label == CONTENT)
    symbols = sum(data.count(symbol) for symbol in (bytes([s]) for s in SYMBOLS))
    return len(words), chars, symbols, repeats, repeated_words(words), content


def judged_column(text: Column) -> Column:
    """The counts of ``judge`` as a struct."""
    field = trained()

    @F.arrow_udf(
        "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
        "n_repeat_words:bigint,content_words:bigint>"
    )
    def judged(texts: pa.Array) -> pa.Array:
        rows = np.array([judge(data, field) for data in text_bytes(texts)], np.int64).reshape(-1, 6)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(6)], names)

    return judged.asNondeterministic()(text)


def _base_failed(counts: str) -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


def _kept(counts: str) -> Column:
    return ~_base_failed(counts) & (F.col(f"{counts}.content_words") >= SHARE * F.col(f"{counts}.n_words"))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, one row per row of ``docs``.

    A null or wordless text has zero counts and fails the base rules. Repeated
    rows are repeated; extra columns are ignored; an empty table gives an empty
    result.
    """
    return docs.select("doc_id", judged_column(F.col("text")).alias("counts")).select(
        "doc_id",
        "counts.n_words",
        "counts.word_chars",
        "counts.n_symbols",
        "counts.n_dup_lines",
        "counts.n_repeat_words",
        _base_failed("counts").alias("base_failed"),
        _kept("counts").alias("kept"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    counts = unused(docs, "__counts")
    return docs.select(*columns, judged_column(F.col("text")).alias(counts)).filter(_kept(counts)).select(*columns)
