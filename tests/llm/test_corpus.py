"""Corpus operators against brute force, the tokenizer library and DuckDB."""

from __future__ import annotations

import io
import os
import random
import re
import zipfile

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm import chosen_path, multi_index, queries, skip_chain, toxicity, warc_zip
from tripmart.llm.common import components
from tripmart.llm.host_paths import main_texts, parse_page
from tripmart.llm.mixing import first_words, mixed_documents, mixture
from tripmart.llm.quality import quality_verdicts
from tripmart.llm.quotes import reply_threads
from tripmart.llm.rank_bpe import RankEncoder, encode_documents

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size int"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def prose(seed: int, words: int) -> str:
    chosen = random.Random(seed)
    return " ".join("".join(chosen.choices("abcdefgh", k=5)) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    base = prose(1, 200)
    near = base.replace(base.split()[100], "other")
    texts = [base, near, base, prose(2, 30), "", None, "one two", "one two", prose(3, 20_000), " \n "]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "r", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, base, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def test_components_find_the_smallest_node(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 200)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots[40] == roots[200] == roots[1] == 1
    assert roots[101] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_base_rules(spark, docs):
    trusted = spark.createDataFrame([(0,), (1,), (None,)], "doc_id long")
    rows = quality_verdicts(docs, trusted).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for row in rows:
        words = WORD.findall(texts[row.doc_id])
        starts = {}
        for i in range(len(words) - 4):
            starts.setdefault(tuple(words[i : i + 5]), []).append(i)
        covered = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(5)}
        assert (row.n_words, row.n_repeat_words) == (len(words), len(covered))
        assert row.word_chars == sum(map(len, words))
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)
    again = spark.createDataFrame([(1, "a b c d e f a b c d e g\nx\nx\n \n", "", "", 0, "", 0)], DOCS)
    row = quality_verdicts(again, trusted).first()
    assert (row.n_repeat_words, row.n_dup_lines, row.n_symbols) == (10, 1, 0)


def test_mixture_meets_targets(spark, docs):
    rows = mixture(docs).collect()
    assert len(rows) == docs.count()
    sources = {}
    for row in rows:
        assert 0 <= row.taken <= 2 * row.size
        size, target, taken = sources.get(row.source, (0, 0, 0))
        sources[row.source] = (size + row.size, row.target, taken + row.taken)
    for size, target, taken in sources.values():
        assert target <= 2 * size and abs(taken - target) <= 1
    assert sorted(map(str, mixture(docs).collect())) == sorted(map(str, rows))
    assert mixed_documents(docs).columns == docs.columns
    cut = spark.createDataFrame([(" a b\n c",)], "t string").select(first_words(F.col("t"), F.lit(2)))
    assert cut.first()[0] == " a b"


def test_near_duplicates_against_brute_force(docs):
    rows = {r.doc_id: r for r in chosen_path.near_duplicates(docs, 3, 85).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: set(chosen_path.shingle_set(t, 3).tolist()) for i, t in texts.items()}
    for i, row in rows.items():
        linked = [
            j for j, s in sets.items()
            if j is not None and s and 100 * len(s & sets[i]) >= 85 * len(s | sets[i])
        ]
        assert row.n_shingles == len(sets[i])
        assert row.component_id == (min(linked) if linked else i)
        assert row.kept == (row.component_id == i)


def test_blocks_of_a_dense_group(spark, monkeypatch):
    """More near copies than a node or block holds: all links are found all the same."""
    monkeypatch.setattr(chosen_path, "NODE_LIMIT", 4)
    monkeypatch.setattr(chosen_path, "LAST_DEPTH", 4)
    base = prose(5, 120).split()
    texts = []
    for i in range(24):
        words = list(base)
        for place in random.Random(i).sample(range(120), 2):
            words[place] = f"w{i}x{place}"
        texts.append((i, " ".join(words)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    sets = [set(chosen_path.shingle_set(t, 3).tolist()) for _, t in texts]
    label = list(range(24))
    for _ in range(24):
        for i in range(24):
            for j in range(24):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(frame, 3, 85).collect()}
    assert got == dict(enumerate(label))


def test_personal_data(spark):
    text = "a.b@c.de.fg x +1 (414) 555-7134 x 1.2.3.4 x 300.1.1.1 x 4111 1111 1111 1111 x 4111111111111112"
    frame = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in skip_chain.personal_data(frame).collect()}
    assert [rows[1][f"n_{k}"] for k in skip_chain.KINDS] == [1, 1, 1, 1]
    assert rows[2].spans == rows[3].spans == ""
    masked = {r.doc_id: r.text for r in skip_chain.masked_documents(frame).collect()}
    assert masked[1].startswith("[EMAIL] x [PHONE] x [IP] x 300.1.1.1 x [CARD]") and masked[2] is None


def test_personal_data_patterns_like_plain_search():
    chosen = random.Random(3)
    for _ in range(3000):
        text = "".join(chosen.choices("ab12.@+- ()", k=40))
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert list(skip_chain.emails(text)) == want


def test_encoding_like_the_library(docs):
    library = Tokenizer.from_file(VOCABULARY)
    library.no_padding()
    library.no_truncation()
    encoder = RankEncoder(VOCABULARY)
    chosen = random.Random(4)
    texts = ["".join(chosen.choices("aAbΣİé \t\x1c'sldve<>|!?#中🙂0²", k=30)) for _ in range(2000)]
    texts += ["", "thth" * 400, "<|startoftext|> Hi<|endoftext|>", prose(6, 500)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids, count, decoded = encoder.encode(text)
        assert (ids, count) == (" ".join(map(str, want)), len(want))
        assert decoded == library.decode(want, skip_special_tokens=False) == encoder.decode(want)
    rows = encode_documents(docs, VOCABULARY, full=True).collect()
    assert len(rows) == docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 9)} == {0}


def test_archives_round_trip(spark):
    page = "<p>" + "x" * 120
    rows = [(2, "u\r\nv", page), (1, None, page), (3, "w", "short"), (4, "w", "short"), (5, "w", None)]
    rows += [(None, "w", page), (2, "w", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc_zip.archive_round_trip(pages, payload=True).collect()
    assert len(found) == 7
    for r in found:
        assert (r.record_type, r.refers_to) == (("revisit", 1) if r.page_id == 2 else ("response", None))
    assert {bytes(r.payload) for r in found if r.page_id in (1, 5)} == {page.encode(), b""}
    assert warc_zip.archive_round_trip(pages.limit(0)).count() == 0


def test_zip64_directories():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        with archive.open("a", "w", force_zip64=True) as member:
            member.write(b"hello")
        archive.writestr("b", b"x" * 50, zipfile.ZIP_DEFLATED)
        archive.comment = b"PK\x05\x06 in a comment"
    data = out.getvalue()
    places = warc_zip.members(io.BytesIO(data), len(data))
    assert list(places) == ["a"]
    assert warc_zip.read_range(io.BytesIO(data), *places["a"]) == b"hello"


def test_toxicity_learns_and_ignores_groups(spark):
    rows = [(i, f"{prose(i, 20)} {'scum idiot' if i % 2 else 'friend'}", i % 2) for i in range(400)]
    frame = spark.createDataFrame([r[:2] for r in rows] + [(1000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    scores = {r.doc_id: r for r in toxicity.toxicity_scores(frame, labels).collect()}
    held = [r for i, r in scores.items() if r.held_out and i < 1000]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)
    empty = toxicity.toxicity_scores(frame, labels.limit(0)).collect()
    assert len(empty) == 401 and not any(r.predicted for r in empty)


def test_swap_penalty_shrinks_group_weights():
    feature = lambda text: toxicity.text_features(text)
    texts = ["scum women"] * 60 + ["nice men"] * 60 + ["scum all"] * 20 + ["nice all"] * 20
    labels = np.array([1] * 60 + [0] * 60 + [1] * 20 + [0] * 20)
    swaps = [p for t in texts for p in toxicity.swapped_sentences(t, ("women", "men"))]
    plain = toxicity.fit([feature(t) for t in texts], labels, swaps, swap_weight=0.0)
    fair = toxicity.fit([feature(t) for t in texts], labels, swaps, swap_weight=20.0)
    gap = lambda s: s.score("women", {}) - s.score("men", {})
    assert abs(gap(fair)) < abs(gap(plain)) / 3


def test_vector_links_against_brute_force(spark):
    random_ = np.random.default_rng(1)
    centres = random_.normal(size=(30, 16))
    points = (centres[:, None] + random_.normal(size=(30, 6, 16)) * 0.12).reshape(-1, 16)
    rows = [(i, p.tolist(), i % 2) for i, p in enumerate(points)]
    rows += [(500, rows[0][1], 0), (501, [0.0] * 16, 0), (502, None, 1), (503, rows[0][1], None)]
    rows += [(504, [float("nan")] * 16, 1), (505, [None] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in multi_index.vector_links(frame).collect()}
    units = {i: multi_index.unit(v) for i, v, label in rows if label is not None}
    label = {i: k for i, _, k in rows}
    near = lambda i, j: i != j and units[i] @ units[j] >= 0.98
    for i in got:
        links = [j for j in units if units.get(i) is not None and units[j] is not None
                 and label[i] == label[j] and near(i, j)]
        assert got[i].n_links == len(links)
        assert got[i].component_id <= min([i, *links])


def test_nearest_cells_come_in_order():
    first, second = np.random.default_rng(2).random((2, 6))
    sums = (first[:, None] + second).ravel()
    cells = multi_index.nearest_cells(first, second, 36)
    assert sorted(cells) == list(range(36)) and (np.diff(sums[cells]) >= 0).all()


def test_main_texts(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body>"
        "<nav><a href=/>menu</a></nav><div class='ad'>buy</div><article><h1>Head</h1>"
        "<p><b>One &amp; two<br>\n more<p>Next {}</p><div class='comments'><p>Nice!</p></div>"
        "</article><footer>end</footer>"
    )
    rows = [(i, f"http://h.example/{i}", page.format("long text " * 20)) for i in range(3)]
    rows += [(3, None, None), (4, "odd", ""), (5, "http://h.example/x", "<div>other page</div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in main_texts(frame).collect()}
    assert got[0].text == "Head\n\nOne & two more\n\nNext " + ("long text " * 20).strip()
    assert got[0].n_chars == len(got[0].text)
    assert (got[3].text, got[4].text, got[5].text) == ("", "", "other page")
    assert parse_page("<" * 1000).blocks


def test_replies_follow_what_they_quote(spark):
    rows = [
        (1, 0, "user", "Hello there\nfriend"),
        (1, 1, "assistant", "> Hello there\n> friend\nI am fine."),
        (1, 2, "user", ">> Hello there\n>> friend\n> I am fine.\nGreat"),
        (1, 3, "user", "> hello THERE\nsecond"),
        (1, 4, "user", "> unknown\nx"),
        (2, 0, "user", "> Hello there"),
        (None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {(r.conv_id, r.turn): r for r in reply_threads(frame).collect()}
    assert [got[1, t].reply_to for t in range(5)] == [None, 0, 1, 0, None]
    assert got[1, 2].path == [0, 1, 2] and got[1, 1].text == "I am fine."
    assert got[2, 0].reply_to is None and len(got) == 7


def test_sql_of_the_archive_query(spark, sf_dir):
    sql = queries.oracle_sql()["op3_warc_zip"].replace("FROM pages", f"FROM '{sf_dir}/pages.parquet'")
    want = duckdb.sql(sql).fetchall()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = queries.queries()["op3_warc_zip"](spark, sf_dir).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    trusted = spark.createDataFrame([], "doc_id long")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for result in (
        quality_verdicts(none, trusted),
        mixture(none),
        mixed_documents(none),
        chosen_path.near_duplicates(none),
        skip_chain.personal_data(none),
        encode_documents(none, VOCABULARY),
        toxicity.toxicity_scores(none, labels),
    ):
        assert result.count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert multi_index.vector_links(vectors).count() == 0


def test_pipeline_on_a_table(spark, sf_dir):
    import corpus_pipeline

    result = corpus_pipeline.run(spark, sf_dir)
    assert result.count() > 0 and "ids_sha256" in result.columns
