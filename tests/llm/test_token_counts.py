"""Token counts against the unmodified library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from forgemeter.llm import queries, token_counts
from forgemeter.llm.byte_table import LONGEST, ByteTable, keys_of, padded
from forgemeter.llm.shipping import ship_package

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = DOC + ", n_tokens string, piece string, n string, n_bytes string"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", "s", "t", "re", "ve", "ll", "'s", "'LL", "don't", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "漢", "1", "٣", "½"]
PARTS += [".", "-", "!", "́", "😀", "<|endoftext|>", "<|", "\0", "\x1c", "\x85", "​", "ǅ", "ª", " word", "Extraordinarily"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def kinds():
    return token_counts.character_kinds()


def awkward():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(4_000)]
    points = [rng.randrange(32, 0xD800) for _ in range(15_000)] + [rng.randrange(0xE000, 0x110000) for _ in range(15_000)]
    rng.shuffle(points)
    texts += ["".join(map(chr, points[i : i + 30])) for i in range(0, len(points), 30)]
    return texts + ["", " ", "\n", "'", "'re", "<|endoftext|>", "a" * 3_000, "x y " * 5_000, " " * 3_000 + "é" * 3_000]


def expected(library, texts):
    return [len(one.ids) for one in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("frequent", [[], [b" the", b" ", b"'s", b" a", "é".encode(), b" word", b"Extraordinarily"]])
def test_counts_are_the_librarys(library, kinds, frequent):
    texts = awkward()
    own = token_counts.Lengths(PATH)
    table = token_counts.table_of(frequent, PATH)
    for size in (1, 7, len(texts)):
        some = texts[:200] if size == 1 else texts
        got = [
            n
            for at in range(0, len(some), size)
            for n in token_counts.count_tokens([t.encode() for t in some[at : at + size]], own, kinds, table).tolist()
        ]
        assert got == expected(library, some)


def test_pre_tokens_are_the_librarys(library, kinds):
    texts = [text.replace("<|endoftext|>", "") for text in awkward()[:2_000]]
    starts, lengths, numbers = token_counts.pre_tokens(texts, kinds)
    joined = "\0".join(texts) + "\0"
    got = [[] for _ in texts]
    for at, size, number in zip(starts.tolist(), lengths.tolist(), numbers.tolist(), strict=True):
        got[number].append(joined[at : at + size])
    for text, pieces in zip(texts, got, strict=True):
        spans = [span for _, span in library.pre_tokenizer.pre_tokenize_str(text)]
        assert pieces == [text[a:b] for a, b in spans]


def test_a_worker_keeps_what_it_met_lately(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 50)
    own = token_counts.Lengths(PATH)
    rng = random.Random(2)
    for _ in range(30):
        pieces = [f" w{rng.randrange(200)}".replace("1", "q") for _ in range(40)]
        plain = [p[1:].isalpha() for p in pieces]
        assert own.of([p.encode() for p in pieces], plain) == expected(library, pieces)
        assert len(own.young) <= 90 and len(own.old) <= 90


def test_rows_of_any_kind(spark, library):
    rows = [(1, "One two"), (1, "One two"), (2, None), (3, ""), (None, "x"), (None, None), (4, " \t\n "), (5, "é漢字 " * 3_000)]
    rows += [(6, "a" * 30_000), (7, "x <|endoftext|> y"), (8, "word " * 512), (9, "word " * 511 + "word")]

    def run(schema, rows, **options):
        width = len(schema.split(", "))
        docs = spark.createDataFrame([row + (None,) * (width - 2) for row in rows], schema)
        return sorted((tuple(row) for row in token_counts.token_counts(docs, PATH, **options).collect()), key=repr)

    lengths = expected(library, [text or "" for _, text in rows])
    wanted = sorted(
        ((i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, lengths, strict=True)), key=repr
    )
    assert run(DOC, rows) == run(CLASH, rows) == wanted
    # The sample and the first tier decide nothing.
    assert run(DOC, rows, sample_rows=1, frequent=3) == wanted
    assert run(DOC, []) == []
    assert {over for *_, over in wanted} == {True, False}


def test_the_query_on_whole_tables(spark, library):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lengths = dict(zip(texts, expected(library, [t or "" for t in texts.values()]), strict=True))
    out = queries.QUERIES["op13_token_counts"](spark, SF).collect()
    assert {row.doc_id: (row.n_bytes, row.n_tokens, row.over_limit) for row in out} == {
        i: (len((t or "").encode()), lengths[i], lengths[i] > 512) for i, t in texts.items()
    }
    assert len(out) == len(texts)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="not a byte-level vocabulary"):
        token_counts.Lengths(public_tokenizers.path("word_bpe_49k.json"))


def test_byte_table_against_a_dict():
    rng = np.random.default_rng(4)
    words = {bytes(rng.integers(0, 3, rng.integers(0, LONGEST + 1), dtype=np.uint8)) for _ in range(3_000)}
    known, unknown = sorted(words)[::2], sorted(words)[1::2]

    def keys(strings):
        lengths = np.array([len(s) for s in strings])
        return keys_of(padded(b"".join(strings)), np.cumsum(lengths) - lengths, lengths)

    table = ByteTable(len(known))
    table.add(keys(known[:700]), np.arange(700, dtype=np.int32))
    table.add(keys(known[700:]), np.arange(700, len(known), dtype=np.int32))
    assert table.find(keys(known)).tolist() == list(range(len(known)))
    assert (table.find(keys(unknown)) == -1).all()
    with pytest.raises(ValueError, match="full"):
        table.add(keys(unknown * 3), np.zeros(3 * len(unknown), np.int32))
