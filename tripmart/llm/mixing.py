"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Only DataFrame functions. Documents are measured in their own rows; everything after
that works on one row per source, or on sums over hash ranges of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import WORD, fresh, numbered, stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 42
# A level of the boundary search splits a hash range into so many parts.
LEVEL_BITS = 12
LEVELS = 3


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by ``source`` in code point order, null last.

    The rows are range-partitioned and numbered within their partition; a window runs
    only over the partitions' row counts.
    """
    sort = F.col("source").asc_nulls_last()
    placed = stored(
        sources.orderBy(sort).withColumn("place", F.monotonically_increasing_id())
    ).select("*", F.expr("shiftright(place, 33)").alias("part"))
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("place") % F.lit(1 << 33)
    return placed.join(starts, "part").select(*sources.columns, rank.alias("rank"))


def water_fill(sources: DataFrame, total: Column, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    Sources share ``total`` (of all ``source_size``) by weight; who would get more than
    ``max_epochs`` times its size is clamped there, and what is left is shared again among
    the others until nobody is above. Each round is one aggregate over the sources, and
    it clamps one source at least. Sources without weight or size get 0. What all caps
    together cannot take is not handed out.
    """
    sources = stored(sources)
    cap = F.col("source_size") * max_epochs
    level = None  # words per unit of weight
    while True:
        clamped = F.lit(False) if level is None else F.col("weight") * level >= cap
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(clamped, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        )
        row = sums.select(total.alias("total"), "held", "weight").first()
        total_words, held, weight = row["total"] or 0.0, row["held"] or 0.0, row["weight"] or 0.0
        now = (total_words - held) / weight if weight > 0 else None
        if now is None or (level is not None and now <= level * (1 + 1e-12)):
            break
        level = now
    wanted = F.col("weight") * F.lit(level or 0.0)
    return sources.withColumn("target", F.least(wanted, cap))


def _hash_part(level: int) -> Column:
    """The ``level``-th group of bits of the seeded hash ``h``, from the top."""
    moved = F.shiftrightunsigned("h", 64 - LEVEL_BITS * (level + 1))
    return moved.bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int")


def _taken_extra(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``row, extra``: words that rows take beyond their whole repetitions.

    The rows of a source stand in the order of a seeded hash and are taken until the
    source's budget is spent, the last one in part. Sums over hash ranges find the range
    in which the budget ends; that range is split again. Only the rows of the last
    range (about one in 2^36 of a source, and rows with equal hashes) meet in a window.
    """
    left = budgets.select(
        F.col("source").alias("s"), F.col("budget"), F.lit(0).cast("long").alias("prefix")
    )
    rows = sized.select(
        "row", "size", "h", F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix")
    ).where("size > 0")
    parts = []
    same = ["s", "prefix"]
    for level in range(LEVELS):
        rows = rows.withColumn("part", _hash_part(level))
        sums = rows.groupBy("s", "prefix", "part").agg(F.sum("size").alias("words"))
        before = (
            Window.partitionBy("s", "prefix")
            .orderBy("part")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        bounds = (
            _null_safe(sums, left, same)
            .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .select(
                *same,
                "part",
                (F.col("budget") - F.col("before")).alias("room"),
                "words",
            )
            .where("room > 0")
        )
        bounds = stored(bounds)
        placed = _null_safe(rows, bounds, [*same, "part"])
        parts.append(placed.where("words <= room").select("row", F.col("size").alias("extra")))
        split = F.col("prefix") * (1 << LEVEL_BITS) + F.col("part")
        rows = placed.where("words > room").select(
            "row", "size", "h", "s", split.alias("prefix")
        )
        left = bounds.where("words > room").select(
            "s", F.col("room").alias("budget"), split.alias("prefix")
        )
    order = (
        Window.partitionBy("s", "prefix")
        .orderBy("h", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.col("budget") - F.coalesce(F.sum("size").over(order), F.lit(0))
    last = _null_safe(rows, left, same).select(
        "row", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), room)).alias("extra")
    )
    for part in parts:
        last = last.unionByName(part)
    return last.where("extra > 0")


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join in which null equals null; ``right`` is one row per source or hash range."""
    renamed = right.select(
        *[F.col(n).alias(f"_{n}" if n in names else n) for n in right.columns]
    )
    on = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    return left.join(renamed, on).drop(*[f"_{n}" for n in names])


def mixture(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``source, epochs, extra`` per document.

    Sources in code point order (null is a source, the last) get the ``weights`` in turn
    and share ``share`` of all words, at most ``max_epochs`` times their own. Every
    document is taken ``epochs`` whole times, the floor of target by size, and documents
    in the order of a seeded hash of ``doc_id`` and ``text`` once more until the rest is spent, the
    last of them for its first ``extra`` words only. So a source's taken words are its
    target, rounded, and no document exceeds the next whole number of epochs.

    Null and empty texts have size 0 and take nothing. A null ``doc_id`` is an id like
    others; repeated rows are taken independently, in the order they stand when hashes tie.
    Other columns are dropped. An empty table gives none. A long text is counted in its row.
    """
    return _mixture(docs, F.monotonically_increasing_id(), weights, share, max_epochs, seed).drop(
        "row"
    )


def _mixture(
    docs: DataFrame,
    row: Column,
    weights: Sequence[float],
    share: float,
    max_epochs: float,
    seed: int,
) -> DataFrame:
    """``mixture`` with ``row``, a number of its own for each row."""
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"),
            row.alias("row"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.col("rank") % F.lit(len(weights))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    filled = stored(
        water_fill(
            ranked(sources).select("source", "source_size", weight.alias("weight")),
            F.col("all") * share,
            max_epochs,
        )
    )
    ratio = F.col("target") / F.col("source_size")
    planned = stored(
        filled.where("source_size > 0").select(
            "source",
            F.least(F.floor(ratio), F.lit(int(max_epochs))).cast("long").alias("epochs"),
            F.col("target"),
            "source_size",
        )
    )
    budgets = planned.select(
        "source",
        F.round(F.col("target") - F.col("epochs") * F.col("source_size"))
        .cast("long")
        .alias("budget"),
    ).where("budget > 0")
    extra = _taken_extra(sized, budgets)
    plan = filled.select("source", "source_size", "target")
    epochs = planned.select("source", "epochs")
    facts = _null_safe(sized, plan, ["source"])
    known = facts.join(
        epochs.select(F.col("source").alias("_s"), "epochs"),
        F.col("source").eqNullSafe(F.col("_s")),
        "left",
    ).drop("_s")
    joined = known.join(extra, "row", "left").na.fill({"extra": 0, "epochs": 0})
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        F.col("target"),
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
        "source",
        "epochs",
        "extra",
        "row",
    )


def first_words(text: Column, count: Column) -> Column:
    """A text up to the end of its ``count``-th word."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(ends, F.lit(1), count.cast("int")), "")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mixture itself: a row of ``docs`` for each repetition of a document.

    A partial repetition holds the first words only, and ``n_chars`` follows its text.
    Documents that take nothing are gone. Rows with the same ``doc_id`` or without one are
    documents each, so what a source's rows take is its target whatever their ids.
    Further columns of any name are kept.
    """
    given = docs.columns
    docs, row = numbered(docs)
    taken = _mixture(docs, F.col(row), weights, share, max_epochs, seed)
    name, words = fresh("plan", docs), fresh("words", docs)
    # One column that no column of docs is called holds all that is planned.
    plan = taken.where("taken > 0").select(F.struct("row", "epochs", "extra", "size").alias(name))
    epochs, extra, size = (F.col(name)[field] for field in ("epochs", "extra", "size"))
    chosen = docs.join(plan, F.col(row) == F.col(name)["row"])
    copies = F.concat(
        F.array_repeat(size, epochs.cast("int")),
        F.when(extra > 0, F.array(extra)).otherwise(F.array().cast("array<long>")),
    )
    each = chosen.select(*given, name, F.explode_outer(copies).alias(words))
    cut = F.col(words) < size
    text = F.when(cut, first_words(F.col("text"), F.col(words))).otherwise(F.col("text"))
    result = each.withColumn("text", text)
    if "n_chars" in given:
        result = result.withColumn(
            "n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return result.select(*given)
