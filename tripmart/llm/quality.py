"""Quality rules: base text rules and a hashed n-gram log-likelihood ratio.

Only DataFrame functions: every text is measured in its own row, and only counts of
hashed n-grams are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import dense_array, maybe_in, words_of

# Runs of letters, digits and "_", or runs of anything else but white space.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BUCKETS = 1 << 14
# Mean log-likelihood ratio per n-gram under which a text is rejected.
MIN_SCORE = -0.5
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base_rules(docs: DataFrame, keep: str = "doc_id") -> DataFrame:
    """``keep`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long)
    and ``base_failed``, plus ``text`` (null as empty).

    A null or empty text has no words, so it fails. Rows are measured one by one:
    repeated rows and ids each stay a row. Other columns are dropped. Windows and words
    are compared by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select(keep, text.alias("text")).select(
        keep, "text", words_of(F.col("text")).alias("words"), lines.alias("lines")
    )
    measured = parts.select(
        keep,
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)]),
    )
    enough = F.size("hashes") >= WINDOW
    windows = measured.withColumn(
        "windows", F.when(enough, window).otherwise(F.array().cast("array<long>"))
    )
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = windows.withColumn("ordered", F.when(repeats, ordered))
    again = F.transform(
        "ordered",
        lambda w, k: F.when(
            (w["h"] == F.get(F.col("ordered"), k + 1)["h"])
            | ((k > 0) & (w["h"] == F.get(F.col("ordered"), F.greatest(k - 1, F.lit(0)))["h"])),
            w["i"],
        ),
    )
    starts = F.array_sort(F.filter(again, lambda i: i.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - i)).alias("n"),
            (i + WINDOW).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    ruled = placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    few = F.col("n_words") < MIN_WORDS
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return ruled.withColumn("base_failed", few | repeated).drop("hashes", "windows", "ordered")


def _hashed_tokens(texts: DataFrame, *keep: str, buckets: int) -> DataFrame:
    """``keep`` and ``hashes``, the buckets of the tokens of ``text`` in order."""
    token_list = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    tokens = texts.select(*keep, token_list.alias("tokens"))
    bucket = F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("short"))
    return tokens.select(*keep, bucket.alias("hashes"))


def _grams(hashed: DataFrame, *keep: str, buckets: int) -> DataFrame:
    """``keep`` and ``grams``: the buckets of the tokens and of their neighbouring pairs."""
    double = F.transform(
        "hashes",
        lambda h, i: F.pmod(F.xxhash64(h, F.get(F.col("hashes"), i + 1)), F.lit(buckets)),
    )
    pairs = F.slice(double, 1, F.greatest(F.size("hashes") - 1, F.lit(0)))
    return hashed.select(*keep, F.concat(F.col("hashes").cast("array<long>"), pairs).alias("grams"))


def _counts(hashed: DataFrame, buckets: int) -> DataFrame:
    # A plain explode would also filter on the array's size, evaluating it twice.
    grams = _grams(hashed, buckets=buckets).select(F.explode_outer("grams").alias("slot"))
    return grams.groupBy("slot").agg(F.count("*").alias("n"))


def ngram_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(slot, value): log ratio of each hashed n-gram's share in the trusted texts to its
    share in all texts, both with one added per bucket.

    ``trusted`` holds ``doc_id`` of trusted documents; null ids and ids without a document
    count for nothing. All texts are counted, repeated rows each time.
    """
    if buckets > 1 << 15:
        raise ValueError("buckets are kept as short integers: 32768 at most")
    ids = trusted.where("doc_id is not null").select("doc_id").distinct()
    raw = _hashed_tokens(docs, "doc_id", buckets=buckets)
    # Two bytes a token are shuffled, of little more than the trusted texts.
    near = _hashed_tokens(docs.where(maybe_in(F.col("doc_id"), ids)), "doc_id", buckets=buckets)
    target = near.join(ids, "doc_id")
    both = (
        _counts(raw, buckets)
        .withColumn("t", F.lit(0).cast("long"))
        .union(_counts(target, buckets).select("slot", F.lit(0).cast("long"), "n"))
        .groupBy("slot")
        .agg(F.sum("n").alias("raw"), F.sum("t").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("slot"))
    filled = every.join(both, "slot", "left").na.fill(0)
    total = filled.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    scale = total.select(
        F.log((F.col("raw") + buckets) / (F.col("target") + buckets))
    ).scalar()
    ratio = F.log((F.col("target") + 1) / (F.col("raw") + 1)) + scale
    return filled.select("slot", ratio.alias("value"))


def _judged(
    docs: DataFrame, keep: str, weights: DataFrame, buckets: int, min_score: float
) -> DataFrame:
    """``keep`` and ``verdict``, a struct of ``FACTS``, ``score`` and ``kept``, per row.

    The weights are a scalar, as long as ``buckets``, that every row looks its own n-grams
    up in: no row is split or shuffled.
    """
    ruled = base_rules(docs, keep)
    hashed = _hashed_tokens(ruled, keep, *FACTS, buckets=buckets)
    n_tokens = F.size("hashes")
    counted = hashed.withColumn("n_grams", n_tokens + F.greatest(n_tokens - 1, F.lit(0)))
    grams = _grams(counted, keep, *FACTS, "n_grams", buckets=buckets)
    table = dense_array(weights, buckets, F.lit(0.0))
    # One use of "grams" and one of "weights": the optimizer then makes one step of all,
    # which looks into the table itself instead of copying it into every row.
    total = F.aggregate(
        "grams", F.lit(0.0), lambda acc, slot: acc + F.get(F.col("weights"), slot.cast("int"))
    )
    score = F.when(F.col("n_grams") > 0, total / F.col("n_grams")).otherwise(F.lit(0.0))
    scored = grams.withColumn("weights", table).select(keep, *FACTS, score.alias("score"))
    kept = ~F.col("base_failed") & (F.col("score") >= min_score)
    verdict = F.struct(*FACTS, "score", kept.alias("kept"))
    # The explode keeps filters on the verdict from being computed a second time below it.
    return scored.select(keep, F.explode_outer(F.array(verdict)).alias("verdict"))


def quality_verdicts(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Base rules of every document with ``score`` and ``kept``.

    ``score`` is the log-likelihood ratio of trusted to all texts divided by the number of
    n-grams, 0 for a text without any. A document stays if no base rule fails and its score
    is at least ``min_score``; the threshold is one number for every document. Without
    trusted documents all scores come from all texts against even shares. Every row is
    judged by its own text, whatever its id and however long it is; other columns are
    dropped. An empty table gives none.
    """
    weights = ngram_weights(docs, trusted, buckets)
    return _judged(docs, "doc_id", weights, buckets, min_score).select("doc_id", "verdict.*")


def good_documents(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps, each judged for itself, so rows
    with one id or without an id may differ. All columns stay, whatever their names."""
    weights = ngram_weights(docs, trusted, buckets)
    whole = docs.select("text", F.struct("*").alias("doc"))
    judged = _judged(whole, "doc", weights, buckets, min_score)
    return judged.where("verdict.kept").select("doc.*")
