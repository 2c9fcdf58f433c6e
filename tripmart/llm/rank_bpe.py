"""Byte-pair encoding with a contiguous rank array per word, and decoding.

The vocabulary file is read once on the driver and broadcast: its size is that of the
file, whatever the corpus. Texts are encoded in Arrow batches where they lie; nothing is
shuffled. Python is used because the merge loop has no DataFrame form.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import DataFrame

# Fixed values of the vocabulary's pre-tokenizer: white space, and the parts of a text.
SPACES = r"[\t-\r \x85\xa0  -     　]+"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^ \p{L}\p{N}]+"
# Words above this many symbols are merged with a heap; the result is the same.
SHORT = 64
# A task forgets its encoded words beyond this number; it then encodes them again.
CACHED_WORDS = 200_000
NO_MERGE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible
    Latin-1, else the next free code point from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, free = [], 256
    for byte in range(256):
        if byte in visible:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(free))
            free += 1
    return symbols


class RankEncoder:
    """Encoder and decoder of one vocabulary; pickled as its tables."""

    def __init__(self, path: str):
        model = json.loads(Path(path).read_text(encoding="utf-8"))
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.suffix: str = model["model"]["end_of_word_suffix"] or ""
        self.special = {token["content"]: token["id"] for token in model["added_tokens"]}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merged = self.ids[left + right]
            self.merges[self.ids[left], self.ids[right]] = (rank, merged)
        self.words: dict[str, tuple[str, int, str]] = {}

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ids", "suffix", "special", "merges")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.words = {}

    @cached_property
    def tokens(self) -> dict[int, str]:
        """Token text of each id."""
        return {i: t for t, i in [*self.ids.items(), *self.special.items()]}

    @cached_property
    def _tools(self) -> tuple:
        marks = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        split = regex.compile(f"({marks})") if marks else None
        return split, regex.compile(SPACES), regex.compile(PIECES), byte_symbols()

    def normalised(self, text: str) -> str:
        """NFC, white space runs as one space, lower case character by character."""
        text = self._tools[1].sub(" ", unicodedata.normalize("NFC", text))
        return text.replace("Σ", "σ").lower()

    def merge_short(self, parts: list[int]) -> list[int]:
        """Merge with an array of the ranks of neighbouring parts.

        The leftmost smallest rank goes first: its boundary is deleted, and only the
        ranks on both sides of the merged part are looked up again.
        """
        merges = self.merges
        none = (NO_MERGE, 0)
        pairs = [merges.get(pair, none) for pair in zip(parts, parts[1:])]
        ranks = [rank for rank, _ in pairs]
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            i = ranks.index(least)
            parts[i] = merges[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), none)[0]
            if i > 0:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), none)[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges, smallest rank and then leftmost, from a heap: a long word costs
        the length times its logarithm instead of its square."""
        merges = self.merges
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := merges.get((parts[i], parts[j]))):
                heapq.heappush(heap, (found[0], i, parts[i], parts[j], found[1]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part in parts if part >= 0]

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word; symbols outside the vocabulary have none."""
        symbols = self._tools[3]
        spelled = [symbols[byte] for byte in word.encode("utf-8", "surrogatepass")]
        spelled[-1] += self.suffix
        parts = [self.ids[symbol] for symbol in spelled if symbol in self.ids]
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def _word(self, word: str) -> tuple[str, int, str]:
        ids = self.word_ids(word)
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        names = self.tokens
        found = " ".join(map(str, ids)), len(ids), " ".join([names[i] for i in ids])
        if len(word) <= SHORT:
            self.words[word] = found
        return found

    def encode(self, text: str) -> tuple[str, int, str]:
        """Ids joined by spaces, their number, and the decoded text."""
        split, _, pieces, _ = self._tools
        known = self.words
        found = []
        for place, part in enumerate(split.split(text) if split else [text]):
            if place % 2:
                found.append((str(self.special[part]), 1, part))
            elif part:
                for word in pieces.findall(self.normalised(part)):
                    found.append(known.get(word) or self._word(word))
        used = [f for f in found if f[1]]
        return (
            " ".join([f[0] for f in used]),
            sum([f[1] for f in used]),
            " ".join([f[2] for f in used]),
        )

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a space, as the vocabulary's file names no decoder."""
        names = self.tokens
        return " ".join(names[i] for i in ids if i in names)


def encode_documents(docs: DataFrame, path: str, full: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, and with ``full``
    also ``ids`` (joined by spaces) and ``decoded``.

    Null and empty texts, and texts of white space, have no tokens: the digests are those
    of the empty string. Texts are encoded whole, rows one by one, whatever their ids;
    other columns are dropped.
    """
    coder = docs.sparkSession.sparkContext.broadcast(RankEncoder(path))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if full else [])
    kinds = ["long", "string", "string", "string", "string"]
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = coder.value
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids, count, decoded = encoder.encode(text or "")
                rows.append(
                    (
                        count,
                        hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                        ids,
                        decoded,
                    )[: len(names)]
                )
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(encoded, schema)
