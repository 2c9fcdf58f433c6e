"""Spelling variants, exact top-k and the filter audit against brute force."""

from __future__ import annotations

import math
import os
import random
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from comparing import spark_rows
from tripmart.llm import queries, spelling, top_k
from tripmart.llm.filter_audit import filter_audit
from tripmart.llm.spelling import one_edit, spelling_variants

import duckdb

DOCS = "doc_id long, text string, lang string, n string, word string, part string, id int, mask int"


@pytest.fixture(scope="module")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck(sf_dir: str, sql: str, *tables: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), Counter(tuple(r[i] for i in order) for r in result.fetchall())


# --- spelling ------------------------------------------------------------------------


def edits(word: str, letters: str) -> set[str]:
    """Everything one edit away, by trying each."""
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for letter in letters:
        found |= {word[:i] + letter + word[i:] for i in range(len(word) + 1)}
        found |= {word[:i] + letter + word[i + 1 :] for i in range(len(word))}
    return found - {word}


def variants(occurrences: list[str], ratio: int = 10) -> Counter:
    counts = Counter(w for w in occurrences if w is not None and len(w) >= 7)
    known = {word: n for word, n in counts.items() if n >= 2}
    letters = "".join({letter for word in known for letter in word})
    forms, rows = {}, {}
    for word, n in known.items():
        near = [other for other in edits(word, letters) if other in known]
        best = min(near, key=lambda other: (-known[other], other), default=None)
        if best and known[best] >= ratio * n:
            forms[word] = best
        rows[word] = len(near)
    result = Counter()
    for word, n in known.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        result[(word, form, root, n, rows[word], known[form] if form else None)] += 1
    return result


def misspelt(seed: int) -> list[str]:
    """Words of few letters, so that many are near, in very different numbers."""
    chosen = random.Random(seed)
    bases = ["".join(chosen.choices("abeéÉ÷z", k=chosen.randint(7, 9))) for _ in range(60)]
    words = []
    for base in bases:
        count = chosen.choice([2, 3, 40, 700])
        words += [base] * count
        for _ in range(12):
            other = chosen.choice(sorted(edits(base, "abéz")))
            words += [other] * chosen.choice([1, 2, 3, 30])
            words += [chosen.choice(sorted(edits(other, "abz")))] * 2
    return words


@pytest.mark.parametrize("limit", [3, 50, spelling.LIMIT])
def test_variants_equal_brute_force(spark, limit):
    words = misspelt(7) + [None, "", "short", "x" * 300, "x" * 300, "x" * 299, "x" * 299]
    words += ["abcdefg"] * 2 + ["gfedcba"] * 2 + ["abcdefh"] * 40 + ["Wörtliçh", "Wörtliçh"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    result = spelling_variants(df, limit=limit)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(tuple(r) for r in result.collect()) == variants(words)


def test_variants_follow_forms_to_the_root(spark):
    words = ["aaaaaaa"] * 2 + ["aaaaaab"] * 20 + ["aaaaabb"] * 200 + ["aaaabbb"] * 2000
    rows = spelling_variants(spark.createDataFrame([(w,) for w in words], "word string"))
    assert {r.word: r.root for r in rows.collect()} == {w: "aaaabbb" for w in set(words)}


def test_one_edit_is_exactly_one():
    for word in ("abcdefg", "aabbaab", "aaaaaaa"):
        near = edits(word, "abx")
        assert all(one_edit(word, other) and one_edit(other, word) for other in near)
        assert not one_edit(word, word)
        twice = {far for other in list(near)[:20] for far in edits(other, "abx")}
        assert not any(one_edit(word, far) for far in twice - near)


def test_variants_query(spark, tmp_path):
    texts = ["Letters letters LETTERS lettres", "lettres " * 40, None, "", "Über über überall " * 30]
    docs = [(i, t, None, "n", "w", "p", 1, 1) for i, t in enumerate(texts)] + [(None, texts[1]) + (None,) * 6]
    docs += [(i, "another anothers " * 9 + "çédille×÷ "[: 9 + i % 2], "x", "", "", "", 0, 0) for i in range(9, 60)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    words = []
    capitals = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for row in docs:
        text = "".join(c if c in "×÷" or c.isalpha() else " " for c in row[1] or "")
        for run in text.translate(capitals).split():
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words.append(run)
    found = queries.op11_spelling_variants(spark, str(tmp_path))
    assert Counter(tuple(r) for r in found.collect()) == variants(words)


def test_no_words_no_variants(spark):
    assert spelling_variants(spark.createDataFrame([], "word string")).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([], "word string"), ratio=1)


# --- top k ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, score long, key string, lane int, id string"


def best_scores(rows: list[tuple], every: int, k: int) -> Counter:
    good = [
        (i, [math.floor(256 * x) if abs(x) < 2**53 else int(x) * 256 for x in v], tuple(v))
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = Counter()
    for query, ints, _ in {(i, tuple(n), raw) for i, n, raw in good if i is not None and i % every == 0}:
        scored = []
        for i, other, _ in good:
            if i != query and len(other) == len(ints):
                score = sum(a * b for a, b in zip(ints, other))
                scored.append((-max(min(score, top_k.MOST), -top_k.MOST), i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            result[(query, rank, i, -score)] += 1
    return result


def test_top_scores_equal_brute_force(spark, monkeypatch):
    chosen = random.Random(3)
    rows = [(i, [chosen.choice([-1.0, 0.5, 0.251, 0.75]) for _ in range(4)]) for i in range(300)]
    rows += [(i, [chosen.gauss(0, 1) for _ in range(4)]) for i in range(300, 400)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(200)] + [rows[0], rows[7], rows[7]]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (None, [0.1] * 4), (2050, None), (2100, [None, 1.0])]
    rows += [(2150, [float("nan"), 1.0]), (2200, [float("inf")] * 4), (2250, []), (2251, [])]
    rows += [(2300, [1.0, 2.0]), (2301, [0.5, 2.0]), (2350, [3.0])]
    rows += [(-50, [1e300, 2.0, 1.0]), (2401, [1e300, 1.0, 1.0]), (2402, [-4e30, 0.0, 0.001])]
    rows += [(2450, [3e14, 1.0, 0.5]), (0, [0.3, 0.3, 0.3, 0.3])]
    df = spark.createDataFrame([(*r, 1, "k", 2, "i") for r in rows], VECTORS)
    is_query = F.col("id") % 50 == 0
    monkeypatch.setattr(top_k, "TASKS", 4)
    for tiles in ((64, 128), (3, 5)):
        monkeypatch.setattr(top_k, "CANDIDATE_ROWS", tiles)
        monkeypatch.setattr(top_k, "QUERY_ROWS", tiles)
        found = top_k.top_k(df, is_query, k=5)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert Counter(tuple(r) for r in found.collect()) == best_scores(rows, 50, 5)
    assert top_k.top_k(df.limit(0), is_query).count() == 0


def test_top_scores_of_integers(spark):
    rows = [(i, [i % 7, i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<int>")
    found = top_k.top_k(df, F.col("id") % 20 == 0, k=2)
    assert Counter(tuple(r) for r in found.collect()) == best_scores(rows, 20, 2)


def test_top_scores_query(spark, sf_dir):
    found = queries.queries()["op12_top_k"](spark, sf_dir)
    assert spark_rows(found) == duck(sf_dir, queries.oracle_sql()["op12_top_k"], "embeddings")


# --- filter audit --------------------------------------------------------------------


def failed(text: str) -> str:
    for mark in "\t\n\x0b\x0c\r":
        text = text.replace(mark, " ")
    words = [word for word in text.split(" ") if word]
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""
    return found + ("D" if set(text) & set("#$%&*|") else "")


def audited(docs: list[tuple], labels: list[tuple]) -> Counter:
    """Every document through every order, one by one."""
    marked = []
    for doc_id, text, lang in docs:
        copy = any(
            doc_id is not None and other is not None and other < doc_id and (same or "") == (text or "")
            for other, same, _ in docs
        )
        flags = [any(l[0] == doc_id and doc_id is not None and l[i] == 1 for l in labels) for i in (1, 2)]
        marked.append((lang or "", failed(text or "") + ("E" if copy else ""), flags))
    table = {}
    for part in {p for p, _, _ in marked}:
        mine = [(fails, flags) for p, fails, flags in marked if p == part]
        share = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order):
                row = [0] * 6
                for fails, (good, toxic) in mine:
                    at = next((i for i, x in enumerate(order) if x in fails), 9)
                    here = at == step
                    row[0] += at > step
                    row[1] += here
                    row[2] += letter in fails and at < step
                    row[3] += fails == letter
                    row[4] += here and good
                    row[5] += here and toxic
                share[letter] += row[1]
                table[(part, order, step + 1)] = row
        for (p, order, step), row in table.items():
            if p == part:
                row.append(share[order[step - 1]])
    return Counter((*key, *row) for key, row in table.items())


def test_audit_equals_brute_force(spark):
    chosen = random.Random(5)
    texts = [None, "", "short #1", "LOUD " * 120, "same words " * 80, " ".join(map(str, range(150)))]
    texts += [" ".join(chosen.choices(["one", "Two", "THREE", "é", "$", "\n"], k=chosen.randint(1, 200))) for _ in range(20)]
    texts.append("x" * 50_000 + " " + " ".join(map(str, range(20_000))))
    docs = [(chosen.choice([None, *range(40)]), chosen.choice(texts), chosen.choice(["en", "de", "", None])) for _ in range(120)]
    docs += [docs[3]] * 4
    labels = [(i, chosen.choice([0, 1, None]), chosen.choice([0, 1, None])) for i in range(0, 40, 2)]
    labels += labels[:5] + [(2, 1, 0), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame([(*d, "n", "w", "p", 1, 2) for d in docs], DOCS)
    told = spark.createDataFrame([(*l, "x", True) for l in labels], "doc_id long, quality int, toxic int, part string, good boolean")
    rows = filter_audit(df, told).collect()
    assert rows[0].__fields__[:3] == ["part", "filter_order", "step"]
    assert Counter(tuple(r) for r in rows) == audited(docs, labels)
    assert filter_audit(df.limit(0), told).count() == 0
    no_labels = filter_audit(df, told.limit(0)).agg(F.sum("good_lost"), F.sum("removed")).first()
    assert no_labels[0] == 0 and no_labels[1] > 0


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_filter_audit"])
def test_queries_equal_sql(spark, sf_dir, name):
    found = queries.queries()[name](spark, sf_dir)
    assert spark_rows(found) == duck(sf_dir, queries.oracle_sql()[name], "documents", "labels")
