"""Near-duplicate vectors by an inverted multi-index.

The halves of unit vectors have independent codebooks, whose product is a grid of cells.
A vector is stored in its own cell and asks in the cells nearest to it, in the order of a
multi-sequence traversal, as many as a target recall needs. Cells are compared in blocks
and exactly; only counts and enough links to join a component leave a task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import components, stored

SIMILARITY = 0.98
CENTROIDS = 32
# Bound of the vectors that the codebooks are fitted on, drawn by a hash.
SAMPLE = 10_000
TARGET_RECALL = 0.999
BLOCK = 2048
SEED = 6


def unit(values) -> np.ndarray | None:
    """The vector with length 1, or None if it is null, zero or not finite."""
    if values is None:
        return None
    vector = np.array([np.nan if v is None else v for v in values], dtype=float)
    with np.errstate(all="ignore"):
        vector = vector / np.abs(vector).max() if len(vector) else vector
        norm = np.linalg.norm(vector)
    return vector / norm if len(vector) and np.isfinite(norm) and norm > 0 else None


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """Centroids of k-means, ten rounds from seeded points."""
    random = np.random.default_rng(SEED)
    centroids = points[random.choice(len(points), min(size, len(points)), replace=False)].copy()
    for _ in range(10):
        nearest = _distances(points, centroids).argmin(axis=1)
        for place in range(len(centroids)):
            if (own := nearest == place).any():
                centroids[place] = points[own].mean(axis=0)
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)).clip(0)


def nearest_cells(first: np.ndarray, second: np.ndarray, count: int) -> list[int]:
    """The cells with the smallest sums of both halves' distances, nearest first.

    Multi-sequence traversal: both halves are sorted, and a heap walks the pairs of ranks,
    a pair entering when its predecessors in both directions are done.
    """
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, done, found = [(first[one[0]] + second[two[0]], 0, 0)], set(), []
    while heap and len(found) < count:
        _, i, j = heapq.heappop(heap)
        found.append(int(one[i]) * len(second) + int(two[j]))
        done.add((i, j))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two):
                if (a == 0 or (a - 1, b) in done) and (b == 0 or (a, b - 1) in done):
                    heapq.heappush(heap, (first[one[a]] + second[two[b]], a, b))
    return found


class MultiIndex:
    """Codebooks of both halves, and how many cells a vector asks."""

    def __init__(self, sample: np.ndarray, similarity: float, recall: float):
        self.half = sample.shape[1] // 2
        self.books = [codebook(part, CENTROIDS) for part in self.halves(sample)]
        # Neighbours at the threshold itself, the hardest to find, of up to 1000 vectors.
        random = np.random.default_rng(SEED)
        some = sample[:1000]
        aside = random.normal(size=some.shape)
        aside -= (aside * some).sum(1, keepdims=True) * some
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
        near = similarity * some + np.sqrt(1 - similarity**2) * aside
        homes = [cells[0] for cells in self.cells(near, 1)]
        total = len(self.books[0]) * len(self.books[1])
        ranks = [
            cells.index(home) for cells, home in zip(self.cells(some, total), homes)
        ]
        self.probes = int(np.quantile(ranks, recall, method="higher")) + 1

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.half], vectors[:, self.half :]

    def cells(self, vectors: np.ndarray, count: int | None = None) -> list[list[int]]:
        parts = zip(self.halves(vectors), self.books)
        first, second = (_distances(part, book) for part, book in parts)
        return [nearest_cells(a, b, count or self.probes) for a, b in zip(first, second)]


def _placed(vectors: DataFrame, indexes) -> DataFrame:
    """``row, label, width, unit, cells`` of vectors that can have links; the first cell is
    home. Vectors of a width without an index share one cell."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [unit(values) for values in batch["embedding"]]
            widths = np.array([0 if u is None else len(u) for u in units])
            for width in np.unique(widths[widths > 0]).tolist():
                good = np.flatnonzero(widths == width)
                index = indexes.value.get(width)
                alike = np.stack([units[n] for n in good])
                rows = batch.iloc[good]
                yield pd.DataFrame(
                    {
                        "row": rows["row"].to_numpy(),
                        "label": rows["label"].to_numpy(),
                        "width": width,
                        "unit": list(alike),
                        "cells": index.cells(alike) if index else [[0]] * len(good),
                    }
                )

    label = vectors.schema["label"].dataType.simpleString()
    schema = f"row long, label {label}, width int, unit array<double>, cells array<int>"
    return vectors.where("label is not null").mapInPandas(place, schema)


def _compared(rows: DataFrame, similarity: float) -> DataFrame:
    """(row, other, n): links counted in each block for ``row``, or one link with n = 0.

    A pair may meet in the home cells of both. The asking vector counts it; the stored one
    counts it only if it does not ask in the other's home itself.
    """
    keys = ["label", "width", "cell", "block", "part"]

    def links(block: pd.DataFrame) -> pd.DataFrame | None:
        asks = block["asks"].to_numpy()
        ask, have = block[asks], block[~asks]
        if not len(ask) or not len(have):
            return None
        one, two = np.stack(ask["unit"]), np.stack(have["unit"])
        ids, others = ask["row"].to_numpy(), have["row"].to_numpy()
        linked = (one @ two.T >= similarity) & (ids[:, None] != others)
        home = np.array([cells[0] for cells in ask["cells"]])
        asked = np.array([np.isin(home, cells) for cells in have["cells"]]).T
        counts = dict.fromkeys([*ids, *others], 0)
        for row, n in [*zip(ids, linked.sum(1)), *zip(others, (linked & ~asked).sum(0))]:
            counts[row] += int(n)
        found = [(row, None, n) for row, n in counts.items() if n]
        names = {row: row for row in counts}
        for a, b in zip(*np.nonzero(linked)) if linked.any() else ():
            if names[ids[a]] != names[others[b]]:
                found.append((ids[a], others[b], 0))
                gone, new = names[others[b]], names[ids[a]]
                for row in [row for row, name in names.items() if name == gone]:
                    names[row] = new
        return pd.DataFrame(found, columns=["row", "other", "n"]).astype({"other": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby(keys, sort=False):
                if held and (held[0][keys].iloc[0] != part[keys].iloc[0]).any():
                    if (out := links(pd.concat(held))) is not None:
                        yield out
                    held = []
                held.append(part)
        if held and (out := links(pd.concat(held))) is not None:
            yield out

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(run, "row long, other long, n long")


def vector_links(
    vectors: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors`` (vec_id, embedding, label).

    Rows of equal labels link where their cosine in double precision is ``similarity`` or
    more. Vectors of different lengths do not link. Null labels, and vectors that are null,
    empty, zero or hold null or non-finite components, link with nothing. Repeated rows are
    vectors of their own that link with each other. A null vec_id links but is no
    component's id; such a row is kept only where its component has none. Other columns are
    dropped, and an empty table gives no rows.

    Codebooks are fitted for each length that is frequent among ``SAMPLE`` vectors drawn by
    a hash; vectors of rare lengths are compared with all of their length and label.
    """
    numbered = stored(
        vectors.select("vec_id", "embedding", "label").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    drawn = (
        numbered.where("label is not null and exists(embedding, x -> x <> 0)")
        .orderBy(F.xxhash64("row", F.lit(SEED)), "row")
        .limit(SAMPLE)
    )
    units = [u for u in map(unit, drawn.select("embedding").toPandas()["embedding"]) if u is not None]
    fitted: dict[int, list[np.ndarray]] = {}
    for vector in units:
        fitted.setdefault(len(vector), []).append(vector)
    indexes = {
        width: MultiIndex(np.stack(sample), similarity, recall)
        for width, sample in fitted.items()
        if width > 1 and len(sample) >= CENTROIDS
    }
    ids = numbered.select("row", "vec_id")
    placed = stored(_placed(numbered, vectors.sparkSession.sparkContext.broadcast(indexes)))
    group = ["label", "width", "cell"]
    have = placed.select("row", "label", "width", F.get("cells", F.lit(0)).alias("cell"))
    ask = placed.select("row", "label", "width", F.explode("cells").alias("cell"))
    sizes = stored(
        have.groupBy(*group).agg(F.count("*").alias("have"))
        .join(ask.groupBy(*group).agg(F.count("*").alias("ask")), group)
        .where("ask > 1")
        .select(
            *group,
            F.ceil(F.col("have") / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("ask") / BLOCK).cast("int").alias("parts"),
        )
    )
    spread = F.xxhash64("row", F.lit(SEED))
    stored_rows = have.join(sizes, group).select(
        "row", *group, F.lit(False).alias("asks"),
        F.pmod(spread, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    asking_rows = ask.join(sizes, group).select(
        "row", *group, F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, "parts").cast("int").alias("part"),
    )
    both = stored_rows.union(asking_rows).join(placed.select("row", "unit", "cells"), "row")
    found = stored(_compared(both, similarity))
    counts = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    edges = found.where("other is not null").select(F.col("row").alias("a"), F.col("other").alias("b"))
    roots = stored(components(edges)).withColumnRenamed("node", "row")
    named = stored(
        ids.join(roots, "row", "left").join(counts, "row", "left").select(
            "row",
            "vec_id",
            F.coalesce("root", "row").alias("root"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        )
    )
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "root").select(
        "vec_id",
        "n_links",
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
