"""Spelling variant grouping by a trie of letter counts.

Every word is a vector of counts, one for each group of letters. A trie arranges words by
length and then by one count after another. A search walks it depth first: a letter
deleted costs one deficit, a letter replaced one deficit and one surplus, and each budget
is one. Words in the leaves reached are verified letter by letter.

Spark holds the upper part of the trie as cells: words with one length and the same first
counts. A cell of more than ``LIMIT`` words is split by its next counts, and one that
still is too large after the last count is dealt into blocks which all its searches ask.
So a task holds ``LIMIT`` words, and searches stream past them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored

# The successive groups; all letters beyond ASCII share the last two.
GROUPS = "e a i n r t s o l d u c m p g h bf vw kqj xyz".split()
LEVELS = len(GROUPS) + 2
DEPTHS = (2, 4, 6, 9, 12, 16, LEVELS)  # counts in a cell's key, split by split
LIMIT = 10_000
BUCKET = 96  # words of a trie node that is not divided further
TOGETHER = 20_000  # searches that walk a trie at once
PAIRS = 1 << 20  # vectors compared at once
SEARCHES_PER_TASK = 200_000

# What a search may still spend: both budgets, a surplus, a deficit, or nothing.
SWAP, SURPLUS, DROP, SPENT = range(4)
STORED, SEARCH = 0, 1

LEVEL_OF = np.array(
    [
        next((level for level, group in enumerate(GROUPS) if chr(code) in group), LEVELS - 2 + code % 2)
        for code in range(128)
    ]
)

# A vector as one number, and the differences that one edit makes. Differences of such
# sums are sums of differences, so none is missed; what else looks like one is verified.
# A replaced letter is searched from the word that loses in the earlier group, a deleted
# one from the longer.
WORD64 = (1 << 64) - 1
UNITS = np.random.default_rng(0).integers(1, 1 << 63, LEVELS, dtype=np.uint64)
SWAPS = {int(x) - int(y) & WORD64 for j, x in enumerate(UNITS) for y in UNITS[:j]} | {0}
DROPS = {-int(unit) & WORD64 for unit in UNITS}
LOOKS_LIKE = np.zeros(1 << 16, dtype=bool)  # by the upper 16 bits
LOOKS_LIKE[[change >> 48 for change in SWAPS | DROPS]] = True

ROWS = "key string, depth int, kind int, state int, word string, n long"


def counts_of(words: Sequence[str]) -> np.ndarray:
    """A row of counts for each word."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.repeat(np.arange(len(words)), lengths)
    levels = np.where(
        letters < 128, LEVEL_OF[np.minimum(letters, 127)], LEVELS - 2 + letters % 2
    )
    counted = np.bincount(rows * LEVELS + levels, minlength=len(words) * LEVELS)
    return counted.reshape(len(words), LEVELS)


def numbers_of(counts: np.ndarray) -> np.ndarray:
    return (counts.astype(np.uint64) * UNITS).sum(axis=1, dtype=np.uint64)


def one_edit(one: str, two: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    longer, shorter = (one, two) if len(one) >= len(two) else (two, one)
    same = 0
    for a, b in zip(longer, shorter):
        if a != b:
            break
        same += 1
    if len(longer) == len(shorter):
        return one != two and longer[same + 1 :] == shorter[same + 1 :]
    return longer[same + 1 :] == shorter[same:]


def spend(count: int, state: int) -> Iterator[tuple[int, int]]:
    """Counts that the next level may have, and what is left then."""
    yield count, state
    if state in (SWAP, DROP) and count:
        yield count - 1, SURPLUS if state == SWAP else SPENT
    elif state == SURPLUS:
        yield count + 1, SPENT


def prefixes(counts: list[int], state: int) -> list[tuple[list[int], int]]:
    """All prefixes that differ from ``counts`` within the budgets."""
    found = [([], state)]
    for count in counts:
        found = [(head + [c], s) for head, left in found for c, s in spend(count, left)]
    return found


class Trie:
    """Words of one length in the order of their counts; a node is a range of them.

    One edit lies in one half of a word and leaves the other as it is, so two words of a
    leaf are compared letter by letter only where their beginnings or their ends agree.
    """

    def __init__(self, words: Sequence[str], level: int):
        counts = counts_of(words)
        order = np.lexsort(counts.T[::-1])
        self.level, self.order, self.counts = level, order, counts[order]
        self.words = [words[place] for place in order]
        self.numbers = numbers_of(self.counts)
        self.length = len(words[0])
        self.begins: dict[str, int] = {}
        self.ends: dict[str, int] = {}
        for head, tail in map(self._halves, self.words):
            self.begins.setdefault(head, len(self.begins))
            self.ends.setdefault(tail, len(self.ends))
        self.halves = self._numbered(self.words)

    def _halves(self, word: str) -> tuple[str, str]:
        """Beginning and end; together they are a stored word, or less than a longer one."""
        head = self.length // 2
        return word[:head], word[head - self.length :]

    def _numbered(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        halves = [self._halves(word) for word in words]
        return (
            np.array([self.begins.get(head, -1) for head, _ in halves]),
            np.array([self.ends.get(tail, -1) for _, tail in halves]),
        )

    def near(self, words: Sequence[str], states: np.ndarray) -> Iterator[tuple[int, int]]:
        """Places of searched and of stored words one edit apart.

        Searches that are in a node with the same budgets go on together.
        """
        counts = counts_of(words)
        numbers = numbers_of(counts)
        halves = self._numbered(words)
        pending = [(0, len(self.words), self.level, np.arange(len(words)), states)]
        while pending:
            start, end, level, asked, left = pending.pop()
            if end - start <= BUCKET or level == LEVELS:
                for search, stored_word in self._alike(start, end, asked, numbers, halves):
                    if self._verified(words[search], stored_word, numbers[search]):
                        yield search, int(self.order[stored_word])
                continue
            column, own = self.counts[start:end, level], counts[asked, level]
            cuts = np.flatnonzero(np.diff(column)) + 1
            for first, last in zip([0, *cuts], [*cuts, end - start]):
                change = column[first] - own
                lost = (change == -1) & ((left == SWAP) | (left == DROP))
                won = (change == 1) & (left == SURPLUS)
                some = np.flatnonzero((change == 0) | lost | won)
                if len(some):
                    then = left[some]
                    then[lost[some]] = np.where(then[lost[some]] == SWAP, SURPLUS, SPENT)
                    then[won[some]] = SPENT
                    pending.append((start + first, start + last, level + 1, asked[some], then))

    def _alike(
        self,
        start: int,
        end: int,
        asked: np.ndarray,
        numbers: np.ndarray,
        halves: tuple[np.ndarray, np.ndarray],
    ) -> Iterator[tuple[int, int]]:
        """Searches and words of a leaf that may differ by one edit."""
        step = max(PAIRS // (end - start), 1)
        for place in range(0, len(asked), step):
            part = asked[place : place + step]
            change = self.numbers[None, start:end] - numbers[part][:, None]
            searches, words = np.nonzero(LOOKS_LIKE[change >> np.uint64(48)])
            searches, words = part[searches], words + start
            close = np.logical_or(
                *(own[words] == other[searches] for own, other in zip(self.halves, halves))
            )
            yield from zip(searches[close].tolist(), words[close].tolist())

    def _verified(self, word: str, place: int, number: np.uint64) -> bool:
        candidate = self.words[place]
        change = int(self.numbers[place]) - int(number) & WORD64
        if change in SWAPS:
            return (change != 0 or candidate > word) and one_edit(word, candidate)
        return change in DROPS and one_edit(word, candidate)


def _key(length: int, counts: list[int]) -> str:
    return f"{length}:{','.join(map(str, counts))}"


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each word as stored in its cell, and its searches in all cells within the budgets."""
    for batch in batches:
        rows = []
        heads = counts_of(batch["word"].tolist())[:, : DEPTHS[0]].tolist()
        for word, n, head in zip(batch["word"], batch["n"], heads):
            length = len(word)
            rows.append((_key(length, head), 0, STORED, SPENT, word, n))
            for other, left in prefixes(head, SWAP):
                rows.append((_key(length, other), 0, SEARCH, left, word, n))
            for other, left in prefixes(head, DROP):
                rows.append((_key(length - 1, other), 0, SEARCH, left, word, n))
        yield pd.DataFrame(rows, columns=["key", "depth", "kind", "state", "word", "n"])


def _deeper(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of split cells, dealt by the next counts."""
    for batch in batches:
        rows = []
        counts = counts_of(batch["word"].tolist()).tolist()
        for row, count in zip(batch.itertuples(index=False, name=None), counts):
            key, depth, kind, state, word, n = row
            part = count[DEPTHS[depth] : DEPTHS[depth + 1]]
            tails = [(part, state)] if kind == STORED else prefixes(part, state)
            for tail, left in tails:
                below = f"{key},{','.join(map(str, tail))}"
                rows.append((below, depth + 1, kind, left, word, n))
        yield pd.DataFrame(rows, columns=list(batch.columns))


def _all_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for word, counts in zip(batch["word"], counts_of(batch["word"].tolist()).tolist()):
            for depth, levels in enumerate(DEPTHS):
                rows.append((_key(len(word), counts[:levels]), depth))
        yield pd.DataFrame(rows, columns=["key", "depth"])


class Cell:
    """The stored words of one cell, and searches that wait for a walk."""

    def __init__(self, depth: int):
        self.level = DEPTHS[depth]
        self.stored: list[tuple[str, int]] = []
        self.asked: list[tuple[str, int]] = []
        self.states: list[int] = []
        self.trie: Trie | None = None

    def walked(self) -> list[tuple[str, int, str, int]]:
        if not self.asked or not self.stored:
            return []
        if self.trie is None:
            self.trie = Trie([word for word, _ in self.stored], self.level)
        words = [word for word, _ in self.asked]
        pairs = self.trie.near(words, np.array(self.states))
        found = [(*self.asked[search], *self.stored[place]) for search, place in pairs]
        self.asked, self.states = [], []
        return found


def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs, each once; rows come cell by cell, stored words before searches."""
    mark, cell = None, None
    columns = ["word", "n", "near", "near_n"]
    for batch in batches:
        found = []
        names = ("key", "block", "depth", "kind", "state", "word", "n")
        for key, block, depth, kind, state, word, n in zip(*(batch[c].tolist() for c in names)):
            if (key, block) != mark:
                found += cell.walked() if cell else []
                mark, cell = (key, block), Cell(depth)
            if kind == STORED:
                cell.stored.append((word, n))
            elif cell.stored:
                cell.asked.append((word, n))
                cell.states.append(state)
                if len(cell.asked) == TOGETHER:
                    found += cell.walked()
        yield pd.DataFrame(found, columns=columns)
    if cell:
        yield pd.DataFrame(cell.walked(), columns=columns)


def near_pairs(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n, near, near_n``: every pair of ``words`` (word, n) one edit apart, once.

    ``words`` holds a word once and should be stored: it is read several times.
    """
    keys = words.select("word").mapInPandas(_all_keys, "key string, depth int")
    full = stored(keys.groupBy("depth", "key").agg(F.count("*").alias("size")).where(F.col("size") > limit))
    deepest = full.agg(F.max("depth")).first()[0]
    rows = words.mapInPandas(_placed, ROWS)
    whole = []
    for depth in range(len(DEPTHS)):
        if deepest is None or depth > deepest:
            whole.append(rows.withColumn("block", F.lit(0)))
            break
        split = full.where(F.col("depth") == depth).select("key", "size")
        met = rows.join(split, "key", "left")
        whole.append(met.where("size is null").drop("size").withColumn("block", F.lit(0)))
        met = met.where("size is not null")
        if depth + 1 < len(DEPTHS):
            rows = stored(met.drop("size").mapInPandas(_deeper, ROWS))
        else:
            blocks = F.ceil(F.col("size") / limit).cast("int")
            own = F.array(F.pmod(F.xxhash64("word"), blocks).cast("int"))
            every = F.sequence(F.lit(0), blocks - 1)
            dealt = F.explode(F.when(F.col("kind") == STORED, own).otherwise(every))
            whole.append(met.withColumn("block", dealt).drop("size"))
    tasks = max(
        int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(words.count() * 8 / SEARCHES_PER_TASK),
    )
    cells = reduce(DataFrame.unionByName, whole).repartition(tasks, "key", "block")
    ordered = cells.sortWithinPartitions("key", "block", "kind")
    return ordered.mapInPandas(_searched, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """``word, root``: the end of each chain of (word, root) steps, by doubling."""
    ends = stored(forms)
    for _ in range(max(steps, 1).bit_length()):
        next_ends = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = stored(
            ends.join(next_ends, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            )
        )
    return ends


def spelling_variants(
    words: DataFrame,
    ratio: int = 10,
    least_length: int = 7,
    least_count: int = 2,
    limit: int = LIMIT,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words in column ``word``.

    A row of ``words`` is one occurrence. Words count that have ``least_length`` code
    points and occur ``least_count`` times. A word's form is its most frequent near word
    (ties: the smallest in code-point order) if that is at least ``ratio`` times as
    frequent; root is where the forms lead. Null words are left out, repeated ones are
    occurrences, words of any length are compared whole, further columns are not read,
    and no words give no rows.
    """
    if ratio < 2:
        raise ValueError("the ratio has to be 2 or more, or forms could go in circles")
    known = stored(
        words.where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )
    pairs = near_pairs(known, limit)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct("word", "near", "near_n"),
                F.struct(
                    F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")
                ),
            )
        ).alias("side")
    ).select("side.*")
    # A negative count puts the most frequent first and, among equals, the smallest word.
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    form_n = -F.col("best.less")
    fits = form_n >= ratio * F.col("n")
    formed = stored(
        known.join(best, "word", "left").select(
            "word",
            F.when(fits, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, form_n).alias("form_n"),
        )
    )
    most = formed.agg(F.max("n")).first()[0] or 1
    chains = formed.where("form is not null").select("word", F.col("form").alias("root"))
    ends = _roots(chains, int(math.log(most, ratio)) + 1)
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
