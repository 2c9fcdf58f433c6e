"""Quotation linking against a plain search, on generated conversations."""

from __future__ import annotations

import random
import re
import time

from tripmart.llm.quotes import reply_threads

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def said(text):
    return [line for line in map(plain, text.split("\n")) if line]


def parsed(text):
    """Own text and passages (level, text) of a message without attributions."""
    own, passages, last = [], [], 0
    for line in text.split("\n"):
        marks = re.match(r"[ \t]*(>[ \t>]*)", line)
        level = marks.group(1).count(">") if marks else 0
        line = line[marks.end() :] if marks else line
        if not level:
            own.append(line)
        elif level == last:
            passages[-1][1].append(line)
        else:
            passages.append((level, [line]))
        last = level
    return "\n".join(own).strip(" "), [(level, "\n".join(lines)) for level, lines in passages]


def says(own, passage):
    lines, wanted = said(own), said(passage)
    runs = [lines[i : i + len(wanted)] for i in range(len(lines) - len(wanted) + 1)]
    pieces = [plain(own), *map(plain, re.split(r"\n\s*\n", own))]
    return bool(wanted) and (wanted in runs or " ".join(wanted) in pieces)


def brute_force(rows):
    answers = {}
    for conv, turn, _, text in rows:
        best = None
        for level, passage in parsed(text)[1]:
            for other, earlier, _, said_there in rows:
                if other == conv and earlier < turn and says(parsed(said_there)[0], passage):
                    best = max(best or (-level, earlier), (-level, earlier))
        answers[conv, turn] = best and best[1]
    return answers


def generated(seed):
    rng = random.Random(seed)
    words = ["Yes", "no.", "maybe", "Thanks!", "Why?", "a b", ""]
    rows = []
    for conv in range(6):
        texts = []
        for turn in range(30):
            lines = []
            for _ in range(rng.randint(0, 2)):
                if texts:
                    source = rng.choice(texts).split("\n")
                    start = rng.randrange(len(source))
                    part = source[start : start + rng.randint(1, 7)]
                    lines += [rng.choice([">", "> ", ">> "]) + line for line in part]
                lines += [rng.choice(words) for _ in range(rng.randint(0, 2))]
            lines += [f"{rng.choice(words)} {rng.choice(words)}" for _ in range(rng.randint(0, 6))]
            texts.append("\n".join(lines))
            rows.append((conv, turn, "user", texts[-1]))
    return rows


def test_links_equal_a_plain_search(spark):
    rows = generated(7)
    got = reply_threads(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_force(rows)
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == want
    assert sum(v is not None for v in want.values()) > 50


def test_some_lines_of_a_paragraph_are_found(spark):
    rows = [
        (1, 0, "user", "one\ntwo\nthree\nfour"),
        (1, 1, "user", "> two\n> three\nyes"),
        (1, 2, "user", "> three\n> two\nno"),
        (1, 3, "user", "> one two three four\nsure"),
    ]
    got = {r.turn: r.reply_to for r in reply_threads(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: 0}


def test_author_lines_go_with_their_quote(spark):
    rows = [
        (1, 0, "user", "How are you?"),
        (1, 1, "user", "On Monday Ann wrote:\n> How are you?\nFine."),
        (1, 2, "user", "Ann schrieb:\n\n> How are you?\nWell."),
        (1, 3, "user", "Bob wrote:\nnothing at all"),
        (1, 4, "user", "I disagree with this:\n> Fine."),
    ]
    got = {r.turn: r for r in reply_threads(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[t].text for t in (1, 3, 4)] == [
        "Fine.", "Bob wrote:\nnothing at all", "I disagree with this:",
    ]
    assert got[2].text.strip() == "Well."
    assert [got[t].reply_to for t in range(5)] == [None, 0, 0, None, 1]


def test_one_line_said_in_thousands_of_turns(spark):
    rows = [(1, turn, "user", "> thanks\nthanks" if turn % 2 else "thanks") for turn in range(12000)]
    rows.append((1, 50000, "user", "> thanks\nbye"))
    began = time.time()
    got = reply_threads(spark.createDataFrame(rows, SCHEMA)).select("turn", "reply_to").collect()
    want = {turn: turn - 1 if turn % 2 else None for turn in range(12000)} | {50000: 11999}
    assert {r.turn: r.reply_to for r in got} == want
    assert time.time() - began < 120


def test_long_texts_empty_tables_and_extra_columns(spark):
    long = "\n".join(f"line {i}" for i in range(30000))
    quoted = "\n".join(f"> line {i}" for i in range(7, 20011))
    rows = [(1, 0, "user", long), (1, 1, "user", quoted + "\nok"), (1, 1, "user", quoted + "\nok")]
    frame = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA + ", row int, hash int, k int")
    got = reply_threads(frame).select("turn", "reply_to", "depth").collect()
    assert sorted(map(tuple, got), key=str) == [(0, None, 0), (1, 0, 1), (1, 0, 1)]
    assert reply_threads(frame.limit(0)).count() == 0
