"""Filter interaction audit: what each filter removes, in every order of the filters.

Documents with the same failures behave alike, so they are counted by part, failures and
labels first. A mask matrix has 0 where a filter fails a class and infinity where not; a
position matrix, the inverse permutations, has the step at which an order applies each
filter. Their min-plus product is the step at which an order removes a class. Counts
are scattered to these steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import words_of

SALTS = 256  # shares of the rows without an id
MEASURES = (
    "kept",
    "removed",
    "redundant",
    "unique_fails",
    "good_lost",
    "toxic_lost",
    "shapley",
)


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that a text fails by itself."""
    words = words_of(text)
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": F.lit(100).cast("long") * distinct < F.lit(80).cast("long") * F.size(words),
        "C": F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_classes(
    docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column], copies: str
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents counted by language and failures.

    ``failures`` are conditions over the column ``text``; bit i of the mask is the i-th of
    them, and the bit after them is ``copies``: an earlier document has the same text.
    Texts are compared by their SHA-256. No text is shuffled, and no key is joined or
    grouped before its rows are counted: copies of a text meet as counts.
    """
    text = F.coalesce("text", F.lit(""))
    bits = sum(
        (condition.cast("int") * (1 << place) for place, condition in enumerate(failures.values())),
        F.lit(0),
    )
    told = docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = told.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("mask"))
    counted = rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # Rows without an id have no label; a salt spreads them.
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0)
    labelled = counted.withColumn("salt", salt).join(
        known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left"
    )
    no = F.lit(False)
    texts = labelled.groupBy(
        "digest",
        "part",
        "mask",
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
    ).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
    )
    earliest = texts.groupBy(F.col("digest").alias("same")).agg(F.min("first.id").alias("least"))
    met = texts.join(earliest, F.col("digest") == F.col("same"))
    is_first = F.col("first.id") == F.col("least")
    spared = F.col("nameless") + F.when(is_first, F.col("first.n")).otherwise(0)
    bit = 1 << len(failures)
    assert copies not in failures
    sides = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), spared.alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - spared).alias("n")),
        )
    ).alias("side")
    split = met.select("part", "good", "toxic", sides).select("part", "good", "toxic", "side.*")
    amount = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), amount("good").alias("good"), amount("toxic").alias("toxic")
    )


def audit_classes(filters: str, classes: pd.DataFrame) -> pd.DataFrame:
    """Every order and step of one part, from its ``mask, n, good, toxic``."""
    count = len(filters)
    orders = np.array(list(permutations(range(count))))
    positions = np.argsort(orders, axis=1)  # inverse permutations: where each filter stands
    masks = classes["mask"].to_numpy()
    fails = (masks[:, None] >> np.arange(count)) & 1 == 1
    cost = np.where(fails, 0.0, np.inf)
    removal = (cost[:, None, :] + positions[None, :, :]).min(axis=2)  # min-plus product
    order = np.broadcast_to(np.arange(len(orders)), removal.shape)
    gone = np.isfinite(removal)
    step = np.where(gone, removal, 0).astype(int)
    weights = classes[["n", "good", "toxic"]].to_numpy(dtype=np.int64)

    def scattered(amount: np.ndarray) -> np.ndarray:
        table = np.zeros((len(orders), count), dtype=np.int64)
        spread = np.broadcast_to(amount[:, None], removal.shape)
        np.add.at(table, (order[gone], step[gone]), spread[gone])
        return table

    removed, good, toxic = (scattered(weights[:, i]) for i in range(3))
    kept = weights[:, 0].sum() - np.cumsum(removed, axis=1)
    # A class is redundant to its failing filters that stand after its removal.
    late = fails[:, None, :] & (positions[None, :, :] > removal[:, :, None])
    by_filter = np.einsum("c,cof->of", weights[:, 0], late.astype(np.int64))
    alone = np.array([weights[masks == 1 << f, 0].sum() for f in range(count)])
    share = np.zeros(count, dtype=np.int64)
    np.add.at(share, orders.ravel(), removed.ravel())
    names = ["".join(filters[f] for f in one) for one in orders]
    return pd.DataFrame(
        {
            "filter_order": np.repeat(names, count),
            "step": np.tile(np.arange(1, count + 1), len(orders)),
            "kept": kept.ravel(),
            "removed": removed.ravel(),
            "redundant": np.take_along_axis(by_filter, orders, axis=1).ravel(),
            "unique_fails": alone[orders].ravel(),
            "good_lost": good.ravel(),
            "toxic_lost": toxic.ravel(),
            "shapley": share[orders].ravel(),
        }
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column] | None = None,
    copies: str = "E",
) -> DataFrame:
    """``part, filter_order, step`` and counts of documents, for every part and order.

    A part is a ``lang`` value, the empty string for null too. ``failures`` names the
    filters by a letter each, with the condition that fails a text in the column ``text``
    (null: empty); ``copies`` names the one that fails a text which a smaller ``doc_id``
    anywhere has. A row without an id is no copy and makes none; rows that repeat an id
    are equals, none before the other. A document is good or toxic if any of its labels
    says so. Texts count whole, further columns are not read, and an empty table gives
    no rows.
    """
    failures = failures or text_failures(F.col("text"))
    filters = "".join(failures) + copies
    classes = failure_classes(docs, labels, failures, copies)

    def audit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # At most one row for each mask.
        table = audit_classes(filters, rows)
        table.insert(0, "part", key[0])
        return table

    counts = ", ".join(f"{name} long" for name in MEASURES)
    return classes.groupBy("part").applyInPandas(
        audit, f"part string, filter_order string, step int, {counts}"
    )
