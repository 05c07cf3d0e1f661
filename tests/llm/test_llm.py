"""Corpus operators on edge cases, against brute force, and against their SQL."""

import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from helpers import DUCK_TYPES, TABLES, duck_rows, spark_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forgemeter.llm import ann, bpe, chat, html_blocks, line_crf, line_dedup, mixing, oracles, quality_model, simhash
from forgemeter.llm import components, queries, wavelet
from forgemeter.llm.shipping import ship_package

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns whose names the operators use inside.
CLASH = DOC + ", fingerprint string, component_id string, taken string, size string, ids string, starts string, key string"
CLASH += ", __id string, __TEXT string, __starts string, __stops string, __counts string, __source string, __times string"
CLASH += ", __turn string, __last string, __conv string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def table(spark, rows, schema=DOC):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(row) + (None,) * (width - len(row)) for row in rows], schema)


def words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{rng.integers(10_000)}" for _ in range(n))


AWKWARD = [
    (1, "One two three four five six.", "en", "a", 1),
    (1, "One two three four five six.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, "x", "en", "a", 1),
    (None, None, None, None, None),
    (4, " \t\n ", "en", "b", 4),
    (5, "é漢字 " * 3000, "xx", "é", 1),
    (6, "\x00\x1c  \x85   <|endoftext|> don't  stop\n\n\nnow", "en", None, 1),
    (7, "a" * 30_000, "en", "a", 1),
    (8, words(3000, 1) + "\n" + words(80, 2), "en", "c", 1),
    (9, "short\n" + words(80, 2) + "\nend", "en", "c", 1),
]

DOC_OPERATORS = {
    "op1": lambda docs: simhash.near_duplicates(docs),
    "op1 stage": lambda docs: simhash.one_of_each(docs),
    "op2": lambda docs: mixing.mix(docs),
    "op2 stage": lambda docs: mixing.mixed_documents(docs),
    "op3": lambda docs: bpe.round_trip(docs, queries.RANKS, public_tokenizers.PATTERN),
    "op6": lambda docs: line_dedup.without_repeated_runs(docs),
    "op9": lambda docs: line_crf.quality(docs),
    "op9 stage": lambda docs: line_crf.kept_documents(docs),
}


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_empty_tables_and_awkward_rows(spark, name):
    work = DOC_OPERATORS[name]
    assert work(table(spark, [])).collect() == []
    plain = work(table(spark, AWKWARD))
    rows = spark_rows(plain)
    # Names that the operator uses inside change nothing.
    clashing = work(table(spark, AWKWARD, CLASH))
    assert spark_rows(clashing.select(*plain.columns) if "stage" in name or name == "op6" else clashing) == rows
    if "stage" not in name:
        assert len(rows) == len(AWKWARD)
    else:
        assert plain.columns == [c.split()[0] for c in DOC.split(", ")]


# SimHash --------------------------------------------------------------------


def brute_fingerprint(text):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(own[i : i + 4]) for i in range(len(own) - 3)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    prints = {i: brute_fingerprint(text) for i, text in texts.items()}
    linked = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = brute_components(linked, sorted(prints))
    got = {row.doc_id: row for row in simhash.near_duplicates(docs).collect()}
    assert {i: row.fingerprint for i, row in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: row.component_id for i, row in got.items()} == expected
    assert linked
    kept = {row.doc_id for row in simhash.one_of_each(docs).collect()}
    assert kept == set(expected.values())


@pytest.mark.parametrize("hot_bucket", [2_000, 5])
def test_links_are_exact_in_dense_groups(spark, hot_bucket):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(2**63))
    values = {centre}
    while len(values) < 300:
        flips = rng.choice(64, rng.integers(1, 9), replace=False)
        values.add(centre ^ sum(1 << int(b) for b in flips))
    values |= {int(v) for v in rng.integers(0, 2**63, 200)} | {0, 2**64 - 1, 15, 31}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    edges = simhash.linked_fingerprints(frame, hot_bucket=hot_bucket)
    roots = {row.src: row.dst for row in components.component_roots(edges).collect()}
    near = [
        (a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= simhash.DISTANCE
    ]
    expected = brute_components(near, sorted(signed))
    assert {v: roots.get(v, v) for v in signed} == expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    found = {r.src: r.dst for r in components.component_roots(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert found == {**{i: 100 for i in range(101, 141)}, **{i: 0 for i in range(1, 50)}}


# Mixing ---------------------------------------------------------------------


def test_mix_meets_targets_and_epochs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).collect()
    total = sum(r.size for r in rows)
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert r.target <= 2 * r.source_size
        by_source.setdefault(r.source, []).append(r)
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        turns = own[0].target // own[0].source_size
        assert all(r.taken >= turns * r.size for r in own)
    assert sum(own[0].target for own in by_source.values()) == pytest.approx(1.5 * total)
    assert spark_rows(mixing.mix(docs.repartition(7))) == spark_rows(mixing.mix(docs))


def test_mixed_documents_come_as_often_as_taken(spark):
    docs = table(spark, [(i, words(10, i), "en", "a" if i < 8 else "b", i) for i in range(16)])
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    times = {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert times == {i: int(t / 10 + 0.5) for i, t in taken.items() if int(t / 10 + 0.5)}


# Tokens ---------------------------------------------------------------------


def test_byte_bpe_equals_tiktoken(spark):
    ranks = bpe.read_ranks(queries.RANKS)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(3)
    letters = list("aab  \n\t  éß漢字🙂'sretl123!?.\x1c\x85\xa0\x0b")
    texts = ["".join(rng.choice(letters, rng.integers(60))) for _ in range(500)]
    texts += ["ab" * 3000, " " * 100, "x  ", "   x", "é" * 63, "y" * 64, "x" * 65, "a \n b"]
    texts += [row[1] or "" for row in AWKWARD]
    own = bpe.codec(queries.RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(texts, own.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text)
    docs = table(spark, AWKWARD)
    coded = bpe.encode_documents(docs, queries.RANKS, public_tokenizers.PATTERN)
    assert sorted((r.decoded for r in bpe.decode_documents(coded, queries.RANKS).collect())) == sorted(
        (row[1] or "").encode() for row in AWKWARD
    )
    digests = bpe.round_trip(docs, queries.RANKS, public_tokenizers.PATTERN).collect()
    expected = {hashlib.sha256((row[1] or "").encode()).hexdigest() for row in AWKWARD}
    assert {r.decoded_sha256 for r in digests} == expected


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (700, 3), (5000, 49_408), (1024, 70_000)):
        ids = rng.integers(0, top, n)
        matrix = wavelet.open_shard(wavelet.shard_file([1, None], [n, 0], ids))[2]
        assert matrix.ids().tolist() == ids.tolist()
        for at in range(0, n, 97):
            assert matrix.access(at) == ids[at]
        for token in {0, 2, *ids[:5].tolist(), 80_000}:
            places = np.flatnonzero(ids == token)
            assert matrix.rank(token) == len(places)
            assert matrix.rank(token, n // 3) == (places < n // 3).sum()
            assert [matrix.select(token, k) for k in range(min(4, len(places)))] == places[:4].tolist()
            with pytest.raises(IndexError):
                matrix.select(token, len(places))


def test_token_files_hold_what_the_library_gives(spark, tmp_path):
    rows = AWKWARD + [(20, "Word, word. a\x1cb İ ǅ don't é 12", "en", "a", 1)]
    docs = table(spark, rows)
    wavelet.write_shards(docs, str(tmp_path / "files"), queries.WORD_VOCABULARY, 2, shard_ids=500)
    got = sorted(
        (r.doc_id is None, r.doc_id, r.start, r.n_tokens, r.ids_crc32)
        for r in wavelet.read_documents(spark, str(tmp_path / "files")).fillna({"doc_id": -1}).collect()
    )
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    library.encode_special_tokens = True
    ids = [[*library.encode(row[1] or "", add_special_tokens=False).ids, 2] for row in rows]
    crcs = [zlib.crc32(np.array(one, "<u4").tobytes()) for one in ids]
    assert sorted(g[3:] for g in got) == sorted((len(one), crc) for one, crc in zip(ids, crcs, strict=True))
    in_order = sorted(got, key=lambda g: g[2])
    assert [g[2] for g in in_order] == [0, *np.cumsum([g[3] for g in in_order])[:-1].tolist()]
    named = [g[1] for g in in_order if g[1] != -1]
    assert named == sorted(named)
    wavelet.write_shards(docs.limit(0), str(tmp_path / "none"), queries.WORD_VOCABULARY, 2)
    assert wavelet.read_documents(spark, str(tmp_path / "none")).collect() == []


SPECIAL = [
    "hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b. <|startoftext|><|endoftext|>, x",
    "<|ENDOFTEXT|> <|EndOfText|> A<|endoftext|>B", "e<|endoftext|>\u0301 İ<|startoftext|>ǅ", "<|endoftext|", "don't<|endoftext|>'s 12.",
    "x\x1c<|endoftext|>\x85y\xa0<|startoftext|>z", "<<|endoftext|>> ...<|endoftext|>..",
]


def test_token_files_of_the_query_are_the_unmodified_librarys(spark, tmp_path):
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    texts = SPECIAL + [row[1] or "" for row in AWKWARD] + ["Word, word. a\x1cb İ ǅ don't é 12"]
    ids = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert 49407 in ids[0]
    own = wavelet.word_encoder(queries.WORD_VOCABULARY, False)
    for text, expected in zip(texts, ids, strict=True):
        assert np.frombuffer(own.encode_batch([text.encode()])[0], "<u4").tolist() == expected
    own = wavelet.WordEncoder(queries.WORD_VOCABULARY, False)
    together = own.encode_batch([text.encode() for text in texts])
    assert [np.frombuffer(one, "<u4").tolist() for one in together] == ids
    table(spark, list(enumerate(texts))).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op8_token_files"](spark, str(tmp_path)).orderBy("doc_id").collect()
    ended = [[*one, queries.END_ID] for one in ids]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(one, "<u4").tobytes()) for one in ended]
    assert [r.start for r in got] == [0, *np.cumsum([len(one) for one in ended])[:-1].tolist()]


@pytest.mark.parametrize("as_text", [True, False])
def test_words_come_and_go_in_the_encoders_memory(monkeypatch, as_text):
    monkeypatch.setattr(wavelet, "CACHED_WORDS", 60)
    parts = ["'", "s", "word", "House", "a.", " ", "  ", "\n", "\r\n", ".", ",", "..", ",.", "é", "É", "漢", "1", "-", "Σ", "ς", "İ"]
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "\0", "\x1c", "\x85", "x" * 30, "Don't", "\u0301", *"abcdefgh"]
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(1_500)] + ["", ". . ,"]
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    library.encode_special_tokens = as_text
    expected = [one.ids for one in library.encode_batch(texts, add_special_tokens=False)]
    own = wavelet.WordEncoder(queries.WORD_VOCABULARY, as_text)
    got = [ids for at in range(0, len(texts), 13) for ids in own.encode_batch([t.encode() for t in texts[at : at + 13]])]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == expected
    assert own.old.size > 0 and own.young.size < 1_000


def test_punctuation_after_a_word_is_learnt_once():
    words_ = ["house", "straße", "l'été", "naïf", "x1", "don't", "ŉō", "e\u0301", "漢", "Σ", "a-b", "÷"]
    tails = ["", "$$$", "!!", "&&&", "...", "'", "');", "\u0338", "'s", "\\`~", "|>", "-_-"]
    texts = [word + tail for word in words_ for tail in tails]
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    for as_text in (True, False):
        own = wavelet.WordEncoder(queries.WORD_VOCABULARY, as_text)
        got = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_batch([t.encode() for t in texts])]
        assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    # Six words and four tails, not each word with each tail.
    own = wavelet.WordEncoder(queries.WORD_VOCABULARY)
    own.encode_batch([(word + tail).encode() for word in words_[:6] for tail in tails[:5]])
    assert own.young.size == 10


# Quality --------------------------------------------------------------------


def test_scores_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.QUERIES["op4_quality_classifier"](spark, sf)
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    for r in scored.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_scores_are_those_of_direct_densities(spark):
    """Means, covariances and log-densities by plain formulas, without sums of products or Cholesky factors."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()
    features = {r.doc_id: np.array(quality_model.statistics((r.text or "").encode())) for r in docs}
    train = {k: [] for k in (0, 1)}
    for doc_id, quality in labels:
        if quality in train and doc_id in features and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            train[quality].append(features[doc_id])
    rows = {k: np.array(own) for k, own in train.items()}
    total = sum(map(len, rows.values()))
    covariance = {k: np.cov(own.T, bias=True) for k, own in rows.items()}
    both = sum(len(rows[k]) / total * covariance[k] for k in rows)
    to_both, to_diagonal = quality_model.SHRINK_TO_BOTH, quality_model.SHRINK_TO_DIAGONAL

    def log_density(k, x):
        mixed = (1 - to_both) * covariance[k] + to_both * both
        mixed = np.where(np.eye(len(mixed)) > 0, mixed, (1 - to_diagonal) * mixed) + quality_model.RIDGE * np.eye(len(mixed))
        off = x - rows[k].mean(axis=0)
        return np.log(len(rows[k]) / total) - 0.5 * (np.linalg.slogdet(mixed)[1] + off @ np.linalg.solve(mixed, off))

    scored = queries.QUERIES["op4_quality_classifier"](spark, SF).collect()
    assert len(scored) == len(docs)
    for row in scored:
        x = features[row.doc_id]
        difference = (log_density(1, x) - log_density(0, x)) / quality_model.TEMPERATURE
        assert np.isclose(row.score, 1 / (1 + np.exp(-difference)), rtol=1e-5, atol=1e-9)


def test_scores_without_labels_and_with_awkward_rows(spark):
    docs = table(spark, AWKWARD)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_model.score_documents(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(None, 1), (1, None), (8, 1), (9, 0), (8, 1), (9, 0), (3, 0), (5, 1)], "doc_id bigint, quality int")
    assert quality_model.score_documents(docs, labels).count() == len(AWKWARD)
    assert quality_model.score_documents(table(spark, []), labels).collect() == []


def brute_repeats(own):
    seen = {}
    for i in range(len(own) - 7):
        seen.setdefault(tuple(own[i : i + 8]), []).append(i)
    return len({i + k for places in seen.values() if len(places) > 1 for i in places for k in range(8)})


def test_base_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in line_crf.quality(docs).collect()}
    for row in docs.collect():
        own = re.findall(r"[^\x20\x09-\x0D]+", row.text)
        lines = [line for line in row.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        found = got[row.doc_id]
        assert found.n_words == len(own)
        assert found.word_chars == sum(map(len, own))
        assert found.n_symbols == len(re.findall(r"[#*$%&|<>]", row.text))
        assert found.n_dup_lines == len(lines) - len(set(lines))
        assert found.n_repeat_words == brute_repeats(own)
        assert found.base_failed == (len(own) < 20 or 100 * found.n_repeat_words > 30 * len(own))
        assert not (found.base_failed and found.kept)


def test_the_field_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    judged = line_crf.quality(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.99
    assert np.mean([not r.kept for r in rows if r.quality == 0]) > 0.85


def test_viterbi_is_the_best_labelling():
    field = line_crf.trained()
    rng = np.random.default_rng(2)
    for n in (1, 2, 7):
        lines = [sorted({0, *rng.choice(len(line_crf.FEATURES), 3).tolist()}) for _ in range(n)]
        score = field.scores(lines)

        def total(labels, score=score):
            return sum(score[i, y] for i, y in enumerate(labels)) + sum(
                field.edge[a, b] for a, b in itertools.pairwise(labels)
            )

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert total(field.decode(lines)) == pytest.approx(total(best))


# Pages ----------------------------------------------------------------------


def test_articles_of_the_pages(spark):
    import html

    for row in html_blocks.extract_pages(spark.read.parquet(f"{SF}/pages.parquet")).join(
        spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = row.html.split("<article>")[1].split("</article>")[0].split("<footer")[0]
        parts = [html.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ", part)).split() for part in re.split("</?p>|</?h1>", article)]
        assert row.text == "\n".join(" ".join(part) for part in parts if part)
        assert row.n_chars == len(row.text)


def test_what_stands_around_an_article_goes():
    page = """<title>T</title><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">We use cookies on this site and you agree to them all of the time.</div>
    <div id=sidebar><p>Some sidebar text with words that go on and on and on for a long while.</p></div>
    <article><h1>Title</h1><p>First&nbsp;para &amp; <b>more</b><p>Second <a href="x>y">link</a>.<div class="ad">Buy</div>
    <form>Name <input></form><script>var a="<p>no</p>"</script><ul><li>item</ul></article>
    <section class="comments"><p>I liked this a lot, thank you for writing it, see you soon.</p></section>
    <footer>foot</footer>"""
    assert html_blocks.main_text(page) == "Title\nFirst para & more\nSecond link .\nitem".replace("link .", "link.")
    long = "word " * 60
    assert html_blocks.main_text(f"<div><a href=/>Menu</a></div><p>{long}</p><p>{long}</p>") == "\n".join([long.strip()] * 2)
    assert html_blocks.main_text("a < b") == ""
    for broken in ("<", "<p", "<div " * 5000, '<a href="' * 999, "<!--", "<script>x", "</p></p>", "<div>" * 20_000):
        assert isinstance(html_blocks.main_text(broken), str)


def test_a_layouts_names_and_a_form_round_the_page_hide_no_article():
    para = "Words of the article that go on and on until there are quite a lot of them."
    article = f"<article><h1>Title</h1><p>{para}</p></article>"
    for opening, ending in (
        ("<div class='layout has-sidebar'>", "</div>"),
        ("<div id='page-no-footer'>", "</div>"),
        ("<div class='with-comments'>", "</div>"),
        ("<div class='page sidebar'>", "</div>"),
        ("<form action=/>", "</form>"),
        ("<form><div><main>", "</main></div></form>"),
    ):
        assert html_blocks.main_text(f"<body>{opening}{article}{ending}") == f"Title\n{para}"
    long = " ".join([para] * 4)
    form = f"<form><header><a href=/>Home</a></header><div id=content><p>{long}</p><p>{long}</p></div></form>"
    assert html_blocks.main_text(f"<body>{form}") == f"{long}\n{long}"
    # Articles that are not the page's stay out.
    for opening in ("<aside>", "<dialog>", "<div id=comments>", "<div class='post-comments'><div>"):
        assert html_blocks.main_text(f"<body>{article}{opening}<article><p>{long}</p></article>") == f"Title\n{para}"
    # What stands in an article's own adverts and menus stays out, too.
    inner = f"<article><h1>Title</h1><div class='ad-slot'>{long}</div><nav>{long}</nav><p>{para}</p></article>"
    assert html_blocks.main_text(f"<body><form>{inner}</form>") == f"Title\n{para}"


PARA = "Words of the article that go on and on until there are quite a lot of them, as in any other text."


@pytest.mark.parametrize(
    "links",
    [
        "<p><a href=/n>Next article one two</a></p>",
        "<ul><li><a href=/t>tags</a><li><a href=/u>spark</a><li><a href=/v>joins</a></ul>",
        f"<a href=/c><h3>Another story you may like</h3><p>{PARA}</p></a><a href=/d><h3>And one more</h3><p>{PARA}</p></a>",
        "<p><a href=/b>Back to the list</a><p><a href=/n>Next article</a>",
    ],
)
def test_link_lists_and_cards_in_an_article_go(links):
    expected = f"Title\n{PARA}\n{PARA}"
    assert html_blocks.main_text(f"<article><h1>Title</h1><p>{PARA}</p><p>{PARA}</p>{links}</article>") == expected


def test_linked_headings_and_lines_between_text_stay():
    page = f"""<article><h1><a href=#t>Title</a></h1><p>{PARA}</p><h2><a href=#s>A section</a></h2><p>{PARA}</p>
    <p><a href=/x>The whole line is a link</a></p><p>{PARA}</p><p>See <a href=/y>this</a></p></article>"""
    lines = ["Title", PARA, "A section", PARA, "The whole line is a link", PARA, "See this"]
    assert html_blocks.main_text(page) == "\n".join(lines)
    # An anchor without a target is no link, and a link that is never closed ends with its block or its container.
    for opened in (f"<a name=top><p>{PARA}</p>", f"<p>{PARA} <a href=/x>left open", f"<div>x<a href=/x></div><p>{PARA}</p>"):
        assert html_blocks.main_text(f"<article><h1>T</h1>{opened}<p>{PARA}</p><p>{PARA}</p></article>").count(PARA) == 3


def test_links_around_blocks_count():
    inside, after = html_blocks.blocks("<div><a href=/x><h3>One two</h3></div><p>Three")
    assert (inside.linked, after.linked) == (2, 0)
    card = html_blocks.blocks("<a href=/x><h3>One</h3><p>two three</p></a><p>four <a href=/y>five</a></p>six")
    assert [(b.linked, len(b.words)) for b in card] == [(1, 1), (2, 2), (1, 2), (0, 1)]


def test_most_decisions_on_the_pages_ask_for_words_or_links(spark):
    def asked(row):
        node, features = html_blocks.tree(), set()
        while not isinstance(node, int):
            feature, threshold, below, above = node
            features.add(html_blocks.FEATURES[feature])
            node = below if row[feature] <= threshold else above
        return bool(features - {"place", "heading"})

    found = []
    for row in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect():
        own = html_blocks.blocks(row.html or "")
        sizes = [(0, 0.0), *((len(b.words), 100.0 * b.linked / len(b.words)) for b in own), (0, 0.0)]
        found += [asked((b.place, b.heading, *sizes[i + 1], *sizes[i], *sizes[i + 2])) for i, b in enumerate(own)]
    assert sum(found) > len(found) / 2


def test_the_tree_fits_its_table():
    import numpy as np

    table = html_blocks.labelled()
    found = [html_blocks.decide(html_blocks.tree(), row) for row in table[:, :-1]]
    assert np.mean(np.array(found) == table[:, -1]) >= 0.97


def test_pages_with_nulls(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, None, None)], "page_id bigint, url string, html string")
    assert {(r.text, r.n_chars) for r in html_blocks.extract_pages(pages).collect()} == {("", 0)}
    assert html_blocks.extract_pages(pages.limit(0)).collect() == []


# Lines ----------------------------------------------------------------------


def test_winnowing_selects_a_line_of_every_window():
    rng = np.random.default_rng(7)
    same = {}
    for _ in range(200):
        own = words(int(rng.integers(0, 90)), int(rng.integers(12))).split()
        own += own[: int(rng.integers(0, 40))]
        lines, stretches, starts, stops = line_dedup.winnow("\n ".join(own).encode(), 20)
        covered = [s for a, b in zip(starts.tolist(), stops.tolist()) for s in range(a, b - 19)]
        assert covered == list(range(len(own) - 19))
        runs = line_dedup.Runs(" ".join(own).encode())
        for line, stretch, a, b in zip(lines, stretches, starts.tolist(), stops.tolist()):
            for s in range(a, b - 19):
                places = np.arange(s, s + 21 - line_dedup.LINE)
                assert runs.hashes(places, places + line_dedup.LINE).min() == line
            assert same.setdefault(stretch, own[a:b]) == own[a:b]
    assert len(same) == len({tuple(v) for v in same.values()})


def test_leftmost_minima():
    rng = np.random.default_rng(8)
    for width in (1, 2, 3, 7, 8, 39):
        values = rng.integers(0, 9, 60)
        expected = [s + int(np.argmin(values[s : s + width])) for s in range(60 - width + 1)]
        assert line_dedup.leftmost_minima(values, width).tolist() == expected


def brute_without_repeats(docs, size):
    """Texts by plain comparison of all runs of ``size`` words."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        if text is None:
            out[doc_id] = None
            continue
        spaced = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)
        own = [w.strip(" \t\n\x0b\x0c\r") for w in spaced]
        ending = text[len("".join(spaced)) :]
        gone = set()
        for s in range(len(own) - size + 1):
            run = tuple(own[s : s + size])
            if run in seen:
                gone.update(range(s, s + size))
            seen.add(run)
        for i in gone:
            if i + 1 < len(own) and i + 1 not in gone:
                spaced[i + 1] = re.sub(r"^[ \t\r\x0b\x0c]+\n", "\n", spaced[i + 1])
        kept = "".join(w for i, w in enumerate(spaced) if i not in gone)
        kept += "" if len(own) - 1 in gone else ending
        out[doc_id] = kept.lstrip(" \t\n\x0b\x0c\r") if 0 in gone else kept
    return out


def test_repeated_runs_are_those_of_plain_comparison(spark):
    rng = np.random.default_rng(11)
    passages = [words(int(rng.integers(14, 60)), seed).split() for seed in range(12)]
    docs = []
    for doc_id in range(160):
        own = []
        for _ in range(rng.integers(0, 6)):
            passage = list(passages[rng.integers(12)])
            if rng.random() < 0.5:
                passage = passage[int(rng.integers(0, 10)) : len(passage) - int(rng.integers(0, 10))]
            if rng.random() < 0.4:
                passage[int(rng.integers(len(passage)))] = f"edit{rng.integers(1000)}"
            if rng.random() < 0.1:
                passage = ["same"] * 70
            own += passage
        docs.append((doc_id, "".join(w + str(rng.choice([" ", " ", "\n", "\n\n", "\t "])) for w in own)))
    docs += [(None, docs[5][1]), (500, None), (501, " \n "), (502, "x" * 20_000)]
    expected = brute_without_repeats(docs, 20)
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_runs(table(spark, docs), 20).collect()}
    assert got == expected
    assert sum(expected[d] != text for d, text in docs) > 60


def test_passages_inside_lines_go(spark):
    passage = words(93, 5)
    docs = [(1, passage), (2, f"one two {passage} three four"), (3, f"five {passage}")]
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_runs(table(spark, docs)).collect()}
    assert got == {1: passage, 2: "one two three four", 3: "five"}


def test_a_hundred_thousand_blank_lines_are_no_burden():
    text = "first\n" + "\n" * 100_000 + words(60, 3) + "\n" * 100_000 + "last"
    assert line_dedup.winnow(text.encode())[3].max() == 62
    assert line_dedup.cut_out(text, [1], [61]) == "first" + "\n" * 100_000 + "last"


def test_repeated_runs_go_and_first_places_stay(spark):
    run, other = words(30, 7) + "\n" + words(30, 8), words(60, 9)
    docs = table(
        spark,
        [
            (1, f"start one\n{run}\nmiddle\n{other}\nend"),
            (2, f"  start two\n{run}  \nsomething"),
            (3, f"{other}\n{words(30, 7)}\n{words(5, 1)}"),
            (4, f"{other}\n{words(40, 4)}\n{other}"),
            (None, other),
            (5, None),
            (6, ""),
        ],
    )
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_runs(docs).collect()}
    assert got == {
        1: f"start one\n{run}\nmiddle\n{other}\nend",
        2: "  start two\nsomething",
        3: f"{words(30, 7)}\n{words(5, 1)}",
        4: words(40, 4),
        None: "",
        5: None,
        6: "",
    }


# Conversations --------------------------------------------------------------


def test_the_stale_reply_is_the_one_before(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "q2"), (1, 3, "assistant", "second"),
        (2, 0, "assistant", "only"), (3, 0, "user", "nobody answers"), (None, 5, "assistant", "x"),
        (None, 5, "assistant", None), (4, 1, "assistant", "b"), (4, 1, "assistant", "b"), (4, None, "assistant", "a"),
        (5, 1, None, "c"), (5, 2, "assistant", None),
    ]
    conversations = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    stale = chat.with_stale_reply(conversations)
    found = sorted(map(tuple, stale.collect()), key=repr)
    told = {(1, 3): "first", (2, 0): "", (4, 1): "b", (5, 2): ""}
    expected = [(*row[:3], told.get(row[:2], row[3])) if row[2] == "assistant" else row for row in rows]
    expected[6] = (None, 5, "assistant", "")
    assert found == sorted(expected, key=repr)
    assert stale.count() == len(rows) and chat.with_stale_reply(conversations.limit(0)).collect() == []
    # Bounded before the shuffle: the rank's limit stands in the tasks that read.
    assert "WindowGroupLimit [conv_id" in stale._jdf.queryExecution().executedPlan().toString()


def test_pairs_share_their_longest_prefix(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, extra int"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (2, 0, "user", None), (3, 0, None, "x"), (None, 0, "user", "n")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 2, "user", "?"), (2, 0, "user", None), (None, 0, "user", "n")]
    pairs = chat.preference_pairs(table(spark, chosen, schema), table(spark, rejected, schema))
    got = {r.conv_id: r for r in pairs.collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].prompt_turns == 1
    for side, text, learned in (("chosen", got[1].chosen, "good"), ("rejected", got[1].rejected, "bad")):
        ((start, stop),) = got[1][f"{side}_spans"]
        assert (got[1].prompt + text)[start:stop] == f"{learned}<|end|>\n"
    assert got[2].prompt_turns == 1 and got[2].chosen == got[2].rejected == ""
    assert got[3].prompt == "" and got[3].rejected == "" and got[3].chosen == "<||>\nx<|end|>\n"
    empty = table(spark, [], schema)
    assert chat.preference_pairs(empty, empty).collect() == []
    assert chat.with_stale_reply(table(spark, chosen, schema)).count() == len(chosen)


# Search ---------------------------------------------------------------------


def test_neighbours_against_all_products(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    vectors[100:500] = vectors[100]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [
        (9000, None, "x"), (9020, [0.0] * 16, "x"), (9040, [float("nan")] * 16, "x"), (9060, [None] * 16, "x"),
        (9080, [1.0], "x"), (None, [1.0] * 16, "x"), (3, vectors[3].tolist(), "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = {}
    for r in ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    products = vectors @ vectors.T
    hits = 0
    for q, found in got.items():
        best = sorted((-products[q, i], i) for i in range(3000) if i != q)[:20]
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(vectors[q] @ vectors[i], abs=1e-12) for i, s in found)
        hits += sum(s >= -best[-1][0] - 1e-9 for _, s in found)
    assert hits / (20 * len(got)) >= 0.9
    copies = [i for i, s in got[200] if s == pytest.approx(vectors[100] @ vectors[100])]
    assert copies == sorted(copies)


def test_recall_holds_where_a_fixed_ratio_loses_neighbours(spark):
    # Few dimensions: the nearest centroid is so near that a fixed multiple of it opens too few lists (0.72 at 1.22).
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    products = vectors @ vectors.T
    np.fill_diagonal(products, -np.inf)
    hits = sum(len(found & set(np.argsort(-products[q])[:20].tolist())) for q, found in got.items())
    assert len(got) == 150 and hits / (20 * len(got)) >= 0.95


def test_equally_near_vectors_go_by_id(spark):
    # Products of signs are whole numbers: most of a query's last places are tied between many vectors, copies among them.
    rng = np.random.default_rng(8)
    vectors = rng.choice([-1.0, 1.0], (5000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q, found in got.items():
        products = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(5000), -products)).tolist() if i != q]
        assert found == sorted(found, key=lambda i: (-products[i], i))
        hits += len(set(found) & set(order[:20]))
    assert len(got) == 250 and hits / (20 * len(got)) >= 0.95


def test_ties_are_cut_by_id():
    # One list of 3,000 vectors with the same product, their ids in no order.
    ids = np.random.default_rng(9).permutation(3_000)
    posted = pa.table({"list": [0] * 3_000, "least": ids.tolist(), "vector": [[1.0, float(i)] for i in ids]})
    asked = pa.table({"query": [7], "lists": [[0]], "vector": [[2.0, 0.0]]})
    found = ann._best(20)(asked, posted)
    assert set(range(21)) <= set(found["least"].to_pylist()) and set(found["score"].to_pylist()) == {2.0}


def test_a_query_alone_in_its_list_reads_the_lists_around():
    angles = np.linspace(0, 1.5, 16)
    centroids = np.column_stack([np.cos(angles), np.sin(angles), np.zeros(16)])
    index = ann.Index(ann.CentroidGraph(centroids), 1.0, np.array([1] + [40] * 15))
    for ratio, read in ((1.22, 2), (3.2, 4)):
        (found,) = index.lists_for(centroids[:1, :2], ratio, 21)
        assert found.tolist() == list(range(read))


def test_copies_in_several_lists_crowd_no_neighbour_out():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(60, 5))
    # The first vectors have four postings each; list 9 is closed to the query.
    postings = [(one, i) for i in range(40) for one in (0, 1, 2, 3)] + [(1, i) for i in range(40, 50)] + [(9, i) for i in range(40, 60)]
    rng.shuffle(postings)
    posted = pa.table({"list": [int(a) for a, _ in postings], "least": [int(i) for _, i in postings],
                       "vector": [vectors[i].tolist() for _, i in postings]})
    query = rng.normal(size=5)
    asked = pa.table({"query": [7], "lists": [[0, 1, 2, 3]], "vector": [query.tolist()]})
    found = ann._best(20)(asked, posted)
    least = found["least"].to_pylist()
    assert len(least) == len(set(least)) == 29
    assert set(least) == set(np.argsort(-vectors[:50] @ query)[:29].tolist())
    assert found["score"].to_pylist() == pytest.approx([vectors[i] @ query for i in least])


def test_boundary_vectors_are_in_two_lists():
    rng = np.random.default_rng(5)
    even = rng.normal(size=(4_000, 64))
    clear = np.repeat(np.eye(8), 300, axis=0) * 50 + rng.normal(size=(2_400, 8)) * 0.1
    shares = []
    for rows, wanted in ((even, 32), (clear, 8)):
        rows = rows / np.linalg.norm(rows, axis=1)[:, None]
        centroids = ann.balanced_centroids(ann.with_norm(rows, 1.0), wanted)
        index = ann.Index(ann.CentroidGraph(centroids), 1.0)
        index.measure_boundary(rows)
        found = list(index.lists_of(rows))
        far = np.sqrt(((index.stored(rows)[:, None] - centroids) ** 2).sum(axis=2))
        # The graph's search may miss a list now and then; what it finds is in order and within the boundary.
        assert np.mean([own[0] == near for own, near in zip(found, far.argmin(axis=1), strict=True)]) > 0.97
        for own, line in zip(found, far, strict=True):
            assert 1 <= len(set(own)) == len(own) <= 2
            assert line[own[0]] <= line[own[-1]] * (1 + 1e-9) <= index.boundary * line[own[0]] * (1 + 1e-6)
        shares.append(np.mean([len(own) == 2 for own in found]))
    # A share of evenly spread vectors, none of clear clusters.
    assert 0.2 <= shares[0] <= 0.4 and shares[1] == 0


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])], "vec_id bigint, embedding array<float>")
    rows = ann.nearest_neighbours(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in rows] == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.nearest_neighbours(few.limit(0), F.lit(True)).collect() == []


# Queries and the pipeline ---------------------------------------------------


@pytest.mark.parametrize("name", sorted(oracles.ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for one in TABLES:
        duck.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SF}/{one}.parquet'")
    result = queries.QUERIES[name](spark, SF)
    relation = duck.execute(oracles.ORACLE[name])
    assert {c: DUCK_TYPES[t] for c, t in result.dtypes} == {c[0]: str(c[1]) for c in relation.description}
    assert spark_rows(result) == duck_rows(relation)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        seen.append(out.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
            docs = spark.createDataFrame(out.collect(), docs.schema)
    assert len(seen) == 5 and 0 < seen[2] <= seen[1] == seen[0] <= 200
    # A run leaves the scratch tables of others alone, and none of its own but its result.
    others = dict(corpus_pipeline._LAST_SCOPE)
    assert corpus_pipeline.run(spark, SF).count() == seen[-1]
    assert others and corpus_pipeline._LAST_SCOPE == others


def test_other_columns_of_conversations_change_nothing(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (None, 0, "assistant", None)]
    plain = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    clashing = plain.select("*", *[F.lit(None).cast("string").alias(n) for n in ("__last", "__conv", "c", "r", "chosen", "rejected")])
    both = [spark_rows(chat.preference_pairs(t, chat.with_stale_reply(t))) for t in (plain, clashing)]
    assert both[0] == both[1] and len(both[0]) == 2


def test_other_columns_change_no_score_text_or_neighbour(spark):
    from forgemeter.llm import html_blocks

    def wider(df, *names):
        return df.select("*", *[F.lit(None).cast("string").alias(n) for n in names])

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = ("score", "features", "held_out", "predicted", "quality", "statistics", "__text")
    assert spark_rows(quality_model.score_documents(docs, labels)) == spark_rows(
        quality_model.score_documents(wider(docs, *names), labels)
    )
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert spark_rows(html_blocks.extract_pages(pages)) == spark_rows(
        html_blocks.extract_pages(wider(pages, "text", "n_chars", "blocks", "__text"))
    )
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    some = F.col("vec_id") % 20 == 0
    assert spark_rows(ann.nearest_neighbours(vectors, some)) == spark_rows(
        ann.nearest_neighbours(wider(vectors, "ids", "score", "query_id", "rank", "list", "group"), some)
    )
