"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks. A pass counts each query's
scores in a histogram over the range that holds its k-th best, and the summed histograms
narrow the range to one of its bins. When all ranges are a single score, a last pass
keeps what lies above it and, of the ties, those with the smallest ids.

Nothing of the scores is stored: passes compute them again, some ``log(range) / log(bins)``
times. Tiles of queries and candidates are dealt by their counts, so a task holds
``QUERY_ROWS`` queries at most, and candidates stream past them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

SCALE = 256
BINS = 512
QUERY_ROWS = (1024, 4096)  # of a tile: least and most
CANDIDATE_ROWS = (4096, 1 << 18)
EXACT = 2.0**53  # sums of doubles below are exact integers
MOST = 1 << 61  # scores beyond are held here
TASKS = 100_000

TILE = ("width", "query_lane", "lane")


def usable(vectors: DataFrame) -> DataFrame:
    """``id, values, width`` of the vectors without null or non-finite components."""
    name = vectors.schema["embedding"].dataType.elementType.typeName()
    values = F.col("embedding")
    if name not in ("float", "double"):
        values = values.cast("array<double>")
    finite = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(finite).select(
        F.col("vec_id").cast("long").alias("id"),
        values.alias("values"),
        F.size(values).alias("width"),
    )


def _lanes(count: Column, share: int, rows: tuple[int, int]) -> Column:
    """How many tiles: a share of all rows each, within the bounds."""
    least, most = rows
    each = F.least(F.greatest(F.floor(count / share), F.lit(least)), F.lit(most))
    return F.greatest(F.ceil(count / each), F.lit(1)).cast("int")


def _sizes(candidates: DataFrame, is_query: Column) -> DataFrame:
    """For each width how many tiles there are, and the longest vector."""
    component = lambda x: F.pow(F.abs(x.cast("double")) * SCALE + 1, F.lit(2.0))
    square = F.aggregate("values", F.lit(0.0), lambda total, x: total + component(x))
    counted = candidates.groupBy("width").agg(
        F.count("*").alias("n"),
        F.count(F.when(is_query, 1)).alias("asked"),
        F.max(square).alias("square"),
    )
    return stored(
        counted.where("asked > 0").select(
            "width",
            _lanes(F.col("asked"), 16, QUERY_ROWS).alias("query_lanes"),
            _lanes(F.col("n"), 64, CANDIDATE_ROWS).alias("lanes"),
            # No score is larger, by Cauchy and Schwarz.
            F.least(F.col("square") * 1.000001 + 2, F.lit(float(MOST))).cast("long").alias("bound"),
        )
    )


def _tiles(queries: DataFrame, candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """Queries and candidates of each tile, queries first, then candidates by id."""
    asked = queries.withColumns(
        {
            "query_lane": F.pmod("key", "query_lanes").cast("int"),
            "lane": F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)),
            "kind": F.lit(0),
        }
    ).drop("lanes", "query_lanes")
    # Row numbers deal equal rows evenly; which tile a row is in does not matter.
    rows = candidates.withColumn("row", F.monotonically_increasing_id())
    none = F.lit(None).cast("long")
    offered = rows.join(sizes, "width").select(
        none.alias("key"),
        "id",
        "values",
        "width",
        none.alias("low"),
        none.alias("span"),
        none.alias("need"),
        F.explode(F.sequence(F.lit(0), F.col("query_lanes") - 1)).alias("query_lane"),
        F.pmod("row", "lanes").cast("int").alias("lane"),
        F.lit(1).alias("kind"),
    )
    tiles = sizes.agg(F.sum(F.col("lanes").cast("long") * F.col("query_lanes"))).first()[0] or 1
    least = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A number of its own: adaptive execution merges by bytes what costs by scores.
    dealt = asked.unionByName(offered).repartition(min(max(tiles, least), TASKS), *TILE)
    return dealt.sortWithinPartitions(*TILE, "kind", F.asc_nulls_last("id"))


def _numbers(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def _integers(values: np.ndarray) -> list[list[int]]:
    """Scaled components as exact integers; large doubles are integers already."""
    return [
        [int(np.floor(x * SCALE)) if abs(x) < EXACT else int(x) * SCALE for x in row]
        for row in values.tolist()
    ]


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products of the scaled vectors."""
    width = queries.shape[1]
    with np.errstate(over="ignore"):
        one, two = np.floor(queries * SCALE), np.floor(candidates * SCALE)
        most = np.abs(one).max(initial=0) * np.abs(two).max(initial=0) * max(width, 1)
    if most < EXACT:
        return (one @ two.T).astype(np.int64)
    one = np.array(_integers(queries), dtype=object)
    two = np.array(_integers(candidates), dtype=object)
    return np.clip(one @ two.T, -MOST, MOST).astype(np.int64)


class Tile:
    """The queries of one tile, in the order of their rows."""

    def __init__(self, batches: list[pa.RecordBatch], width: int):
        table = pa.Table.from_batches(batches)
        take = lambda name: table[name].to_numpy()
        self.key, self.id = take("key"), take("id")
        self.low, self.span, self.need = take("low"), take("span"), take("need")
        self.values = np.concatenate([_numbers(b["values"], width) for b in batches])
        self.width = width
        self.step = -(-self.span // BINS)
        self.counts = None
        self.left = self.need.copy()
        self.asked = set(self.id.tolist())

    def scored(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and which of them count: a query's own row does not."""
        found = scores(self.values, _numbers(batch["values"], self.width))
        valid = np.ones(found.shape, dtype=bool)
        ids = batch["id"].to_pandas(integer_object_nulls=True).to_numpy()
        for place, one in enumerate(ids.tolist()):
            if one in self.asked:
                valid[self.id == one, place] = False
        return found, valid

    def count(self, batch: pa.RecordBatch) -> None:
        found, valid = self.scored(batch)
        place = found - self.low[:, None]
        valid &= (place >= 0) & (place < self.span[:, None])
        place //= self.step[:, None]
        place += np.arange(len(place))[:, None] * BINS
        counted = np.bincount(place[valid], minlength=len(place) * BINS)
        self.counts = counted if self.counts is None else self.counts + counted

    def histogram(self) -> pa.RecordBatch:
        """From the top, the bins that may hold the sought rank: what a tile has below
        them is below the rank for all tiles together."""
        counts = self.counts.reshape(-1, BINS)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, place = np.nonzero((counts > 0) & (above < self.need[:, None]))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.key[query]), pa.array(place), pa.array(counts[query, place])],
            ["key", "bin", "n"],
        )

    def best(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """What lies above the rank's score, and the first ties; candidates come by id."""
        found, valid = self.scored(batch)
        ties = (found == self.low[:, None]) & valid
        ties &= np.cumsum(ties, axis=1) <= self.left[:, None]
        self.left = self.left - ties.sum(axis=1)
        query, place = np.nonzero(ties | ((found > self.low[:, None]) & valid))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.key[query]),
                pa.array(self.id[query]),
                batch["id"].take(pa.array(place)),
                pa.array(found[query, place]),
            ],
            ["key", "query_id", "vec_id", "score"],
        )


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Runs of rows with one tile and kind."""
    names = (*TILE, "kind")
    marks = np.stack([batch[name].to_numpy() for name in names], axis=1)
    cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(marks)]):
        if end > start:
            yield tuple(marks[start, :3]), marks[start, 3], batch.slice(start, end - start)


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tile, pa.RecordBatch | None]]:
    """Each tile with its candidates, batch by batch, then with None."""
    here, asked, tile = None, [], None
    for batch in batches:
        for mark, kind, part in _parts(batch):
            if mark != here:
                if tile:
                    yield tile, None
                here, asked, tile = mark, [], None
            if kind == 0:
                asked.append(part)
            elif asked:
                tile = tile or Tile(asked, int(mark[0]))
                yield tile, part
    if tile:
        yield tile, None


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile, part in _tiled(batches):
        if part is None:
            yield tile.histogram()
        else:
            tile.count(part)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile, part in _tiled(batches):
        if part is not None:
            yield tile.best(part)


def _narrowed(queries: DataFrame, histograms: DataFrame) -> DataFrame:
    """Each query's range reduced to the bin of its rank.

    A query with fewer candidates than its rank keeps its lowest score, so takes all.
    """
    from_top = Window.partitionBy("key").orderBy(F.desc("bin"))
    bins = histograms.groupBy("key", "bin").agg(F.sum("n").alias("n"))
    summed = bins.withColumn("reached", F.sum("n").over(from_top))
    met = queries.select("key", "need").join(summed, "key")
    above = F.col("reached") - F.col("n")
    chosen = met.where((above < F.col("need")) & (F.col("reached") >= F.col("need")))
    chosen = chosen.select("key", "bin", above.alias("above"))
    step = F.expr(f"(span + {BINS - 1}) div {BINS}")
    joined = queries.join(chosen, "key", "left")
    return joined.withColumns(
        {
            "low": F.when(F.col("bin").isNull(), F.col("low")).otherwise(
                F.col("low") + F.col("bin") * step
            ),
            "span": F.when(F.col("bin").isNull(), F.lit(1).cast("long")).otherwise(step),
            "need": F.col("need") - F.coalesce("above", F.lit(0).cast("long")),
        }
    ).drop("bin", "above")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query``, over the column ``id``,
    names the queries. A score is the inner product of the components times 256, rounded
    down; ties go to the smaller id, null last. Candidates are all rows of the query's
    width but those with its id. Vectors that are null, or hold null or non-finite
    components, take no part; empty ones score 0 with each other. Rows that repeat a
    query ask once, rows that repeat a candidate count each. Two different vectors with
    one id are two queries. Scores beyond 2**61 are held there. Further columns are not
    read, and an empty table gives no rows.
    """
    candidates = usable(vectors)
    sizes = _sizes(candidates, is_query)
    asked = candidates.where(is_query).dropDuplicates(["id", "values"])
    queries = stored(
        asked.join(sizes, "width").select(
            F.monotonically_increasing_id().alias("key"),
            "id",
            "values",
            "width",
            (-F.col("bound")).alias("low"),
            (F.col("bound") * 2 + 1).alias("span"),
            F.lit(k).cast("long").alias("need"),
            "lanes",
            "query_lanes",
        )
    )
    span = sizes.agg(F.max("bound")).first()[0]
    span = 1 if span is None else 2 * span + 1
    while span > 1:
        tiles = _tiles(queries, candidates, sizes)
        counts = tiles.mapInArrow(_histograms, "key long, bin long, n long")
        queries = stored(_narrowed(queries, counts))
        span = -(-span // BINS)
    schema = "key long, query_id long, vec_id long, score long"
    found = _tiles(queries, candidates, sizes).mapInArrow(_found, schema)
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
