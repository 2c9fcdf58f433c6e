"""Personal data: base patterns and a skip-chain conditional random field.

Every token that holds a digit or an "@" is a variable with the labels none, email, ip,
card and phone; a token without either is none. Neighbouring variables share a chain
potential, repeated or similar tokens of a document a skip potential. Loopy message
passing gives marginals, so a token that looks doubtful alone follows its repetitions.
The field is fitted by pseudo-likelihood on what the base patterns find.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fresh

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
# Bounds of the fitting sample: documents on average, and tokens.
SAMPLE_DOCS, SAMPLE_TOKENS = 4000, 20_000
ITERATIONS, DAMPING = 10, 0.5
MIN_MARGINAL = 0.5
# Where the weight between repeated tokens starts, on equal labels.
ATTRACTION = 1.5
SEED = 8

# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match starts where a run of digits does: the run's rest would go on the same way.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WHITE = re.compile(r"[\x20\x09-\x0D]")
DIGIT_OR_AT = re.compile("[0-9@]")

Span = tuple[str, int, int]


# --- base patterns ----------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each "@" so that long runs are read once."""
    limit, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > limit and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            limit = found.end()
        else:
            limit = at + 1
        at = text.find("@", limit)


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the base patterns, by kind and start."""
    spans: list[Span] = []
    if "@" in text:
        spans += [("email", start, end) for start, end in emails(text)]
    for found in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            spans.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = found[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, found[0])) <= 15:
                spans.append(("phone", *found.span()))
    return spans


# --- the field's graph ------------------------------------------------------------


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Places of the words that hold a digit or "@"; the text is read once."""
    found, end = [], 0
    hit = DIGIT_OR_AT.search(text)
    while hit:
        start = max(text.rfind(mark, end, hit.start()) for mark in " \t\n\v\f\r") + 1
        start = max(start, end)
        stop = WHITE.search(text, hit.end())
        end = stop.start() if stop else len(text)
        found.append((start, end))
        hit = DIGIT_OR_AT.search(text, end)
    return found


def _bucket(count: int, bounds: tuple[int, ...]) -> int:
    return sum(count >= bound for bound in bounds)


FEATURES = 8 * 6 + 5 * 4 + 128 + 16


def token_features(text: str, start: int, end: int) -> list[int]:
    """Active features: digits by dots, signs, and the word before, hashed."""
    token = text[start:end]
    digits = sum(map(token.count, "0123456789"))
    by_digits = _bucket(digits, (1, 4, 7, 8, 12, 16, 20))
    by_dots = _bucket(token.count("."), (1, 2, 3, 4, 5))
    active = [by_digits * 6 + by_dots]
    at = token.find("@")
    kind = 0 if at < 0 else 1 + (at > 0) + 2 * ("." in token[at:])
    active.append(48 + kind * 4 + _bucket(len(token), (6, 12, 24)))
    letters = any(map(str.isalpha, token))
    number = 16 <= digits <= 19 and luhn("".join(d for d in token if d in "0123456789"))
    signs = [letters, token[0] == "+", "-" in token, "(" in token or ")" in token]
    signs += ["=" in token, ":" in token, number]
    flags = sum(1 << place for place, on in enumerate(signs) if on)
    active.append(68 + flags)
    before = text[max(0, start - 24) : start].split()
    word = before[-1].lower() if before else ""
    active.append(196 + xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) % 16)
    return active


def token_key(token: str) -> str:
    """Equal for repeated and similar tokens: the digits if that is all there is but signs."""
    digits = "".join(filter(str.isdigit, token))
    if len(digits) >= 4 and not any(map(str.isalpha, token)):
        return digits
    return token.strip(".,;:!?()[]<>\"'").lower()


@dataclass
class Graph:
    """Variables of some documents with their edges; no edge leaves a document."""

    active: list[list[int]]
    places: list[tuple[int, int, int]]  # document, start, end
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def field_graph(texts: list[str]) -> Graph:
    """Chain edges join variables with nothing but white space between, skip edges each
    occurrence of a key with the next one: as many edges as variables at most."""
    graph = Graph([], [], [], [])
    for document, text in enumerate(texts):
        last: dict[str, int] = {}
        previous = None
        for start, end in tokens_of(text):
            place = len(graph.places)
            graph.places.append((document, start, end))
            graph.active.append(token_features(text, start, end))
            if previous is not None and start - graph.places[previous][2] <= 1:
                graph.chain.append((previous, place))
            key = token_key(text[start:end])
            if key in last:
                graph.skip.append((last[key], place))
            last[key] = previous = place
    return graph


# --- model ------------------------------------------------------------------------


@dataclass
class Field:
    """Weights: of features by label, and of label pairs along chain and skip edges."""

    nodes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit_field(rows: pd.DataFrame, steps: int = 300, rate: float = 2.0, decay: float = 1e-3) -> Field:
    """Maximum pseudo-likelihood with a Gaussian prior, by gradient ascent.

    Each row has its active features, its label, and how often each label stands before
    and after it on the chain and at the other end of skip edges. The prior of skip weights
    is centred on agreement. Without rows the prior is the result.
    """
    attract = np.eye(LABELS) * ATTRACTION
    nodes = np.zeros((FEATURES, LABELS))
    before, after = np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    skip = attract.copy()
    if len(rows):
        inputs = np.zeros((len(rows), FEATURES))
        active = rows["active"].to_list()
        inputs[np.repeat(np.arange(len(rows)), [len(a) for a in active]), np.concatenate(active)] = 1
        left, right, far = (np.stack(rows[name].to_list()) for name in ("before", "after", "skip"))
        want = np.eye(LABELS)[rows["label"].to_numpy()]
        for _ in range(steps):
            logits = inputs @ nodes + left @ before + right @ after.T + far @ skip
            logits -= logits.max(axis=1, keepdims=True)
            share = np.exp(logits)
            rest = (want - share / share.sum(axis=1, keepdims=True)) / len(rows)
            nodes += rate * (inputs.T @ rest - decay * nodes)
            moved = left.T @ rest + (right.T @ rest).T  # one table for both directions
            before = before + rate * (moved - decay * before)
            after = before
            toward = far.T @ rest
            skip += rate * ((toward + toward.T) / 2 - decay * (skip - attract))
    return Field(nodes, before, skip)


def marginals(field: Field, graph: Graph) -> np.ndarray:
    """Label marginals of every variable by damped sum-product messages, a fixed number of
    rounds for all edges at once."""
    count = len(graph.places)
    unary = field.nodes[np.array(graph.active)].sum(axis=1)
    edges = np.array(graph.chain + graph.skip, dtype=int).reshape(-1, 2)
    if len(edges):
        forward = np.concatenate([np.repeat(field.chain[None], len(graph.chain), 0),
                                  np.repeat(field.skip[None], len(graph.skip), 0)])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        tables = np.concatenate([forward, forward.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(ITERATIONS):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + tables
            top = out.max(axis=1, keepdims=True)
            fresh = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            fresh -= fresh.max(axis=1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * fresh
        unary = unary.copy()
        np.add.at(unary, target, messages)
    shares = np.exp(unary - unary.max(axis=1, keepdims=True)) if count else unary
    return shares / shares.sum(axis=1, keepdims=True)


def _label(spans: list[Span], start: int, end: int) -> int:
    for kind, low, high in spans:
        if low < end and start < high:
            return 1 + KINDS.index(kind)
    return 0


def _training_rows(texts: list[str]) -> Iterator[tuple]:
    """Rows for ``fit_field`` of every variable, labelled by the base patterns."""
    graph = field_graph(texts)
    spans = [base_spans(text) for text in texts]
    labels = [_label(spans[document], start, end) for document, start, end in graph.places]
    sides = np.zeros((3, len(labels), LABELS))
    for one, two in graph.chain:
        sides[0, two, labels[one]] += 1
        sides[1, one, labels[two]] += 1
    for one, two in graph.skip:
        sides[2, two, labels[one]] += 1
        sides[2, one, labels[two]] += 1
    for place, label in enumerate(labels):
        yield graph.active[place], label, *(side[place].tolist() for side in sides)


def train_field(docs: DataFrame) -> Field:
    """Fit the field on tokens of documents drawn by a hash of their ids."""
    total = docs.count()
    share = int(min(1.0, SAMPLE_DOCS / max(total, 1)) * (1 << 20))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < share

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["active", "label", "before", "after", "skip"]
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            found = pd.DataFrame(list(_training_rows(texts)), columns=names)
            found["order"] = [
                xxhash.xxh32_intdigest(f"{n}:{row}") for n, row in enumerate(found["active"])
            ]
            yield found

    schema = (
        "active array<int>, label int, before array<double>, after array<double>, "
        "skip array<double>, order long"
    )
    sample = docs.where(drawn).select("text").mapInPandas(rows, schema)
    return fit_field(sample.orderBy("order").limit(SAMPLE_TOKENS).toPandas())


def field_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text.

    A variable with a likely label and no base span over it adds a span, without the
    punctuation around it; neighbours of one kind are one span.
    """
    graph = field_graph(texts)
    found = [(base_spans(text), []) for text in texts]
    if not graph.places:
        return found
    shares = marginals(field, graph)
    for place in np.flatnonzero(shares[:, 1:].max(axis=1) >= MIN_MARGINAL):
        document, start, end = graph.places[place]
        base, added = found[document]
        text = texts[document]
        while start < end and text[start] in ".,;:!?()[]<>\"'":
            start += 1
        while start < end and text[end - 1] in ".,;:!?()[]<>\"'":
            end -= 1
        if start < end and not _label(base, start, end):
            kind = KINDS[int(shares[place, 1:].argmax())]
            if added and added[-1][0] == kind and start - added[-1][2] <= 1:
                start = added.pop()[1]
            added.append((kind, start, end))
    return found


# --- Spark ------------------------------------------------------------------------


def span_text(spans: list[Span]) -> str:
    """kind:start:end by kind as listed and then start, joined by commas."""
    ordered = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row.

    Counts and digest are those of the base patterns, ``spans`` has the field's too. A null
    or empty text has no spans. Rows are read one by one, whatever their ids; other
    columns are dropped.
    """
    field = docs.sparkSession.sparkContext.broadcast(train_field(docs))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    names = [f"n_{kind}" for kind in KINDS] + ["base_sha256", "spans"]

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for base, added in field_spans([t or "" for t in batch["text"]], field.value):
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                digest = hashlib.sha256(span_text(base).encode()).hexdigest()
                rows.append((*counts, digest, span_text(base + added)))
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    schema = f"doc_id {doc_id}, {counts}, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInPandas(found, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``n_chars`` follows where it changes.

    Null texts stay null. All columns and rows of ``docs`` are kept.
    """
    field = docs.sparkSession.sparkContext.broadcast(train_field(docs))

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        found = field_spans([t or "" for t in texts], field.value)
        pairs = zip(texts, found)
        return pd.Series([t if t is None else masked(t, base + added) for t, (base, added) in pairs])

    name = fresh("masked", docs)
    clean = docs.withColumn(name, mask("text"))
    if "n_chars" in docs.columns:
        changed = ~F.col(name).eqNullSafe(F.col("text"))
        length = F.when(changed, F.length(name).cast("long")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", length)
    return clean.withColumn("text", F.col(name)).select(*docs.columns)
