"""What several corpus operators share: words, stored tables, small arrays, components."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
FILTER_BITS = 1 << 22


def fresh(name: str, df: DataFrame) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local session, where driver and executor are one process, may go without it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read from there.

    Cuts the lineage: neither a lost executor nor a later action computes it again.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a number of its own for each row, and the name of that column.

    Stored, since a row's number depends on how the files are dealt to tasks.
    """
    name = fresh("row", df)
    return stored(df.withColumn(name, F.monotonically_increasing_id())), name


def words_of(text: Column) -> Column:
    """Words of a text, none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def dense_array(values: DataFrame, size: int, default: Column) -> Column:
    """Scalar array of ``size`` slots from (slot, value) rows; its length is its bound.

    ``values`` has at most one row per slot. A scalar subquery reaches the executors
    once, like a broadcast of ``size`` values.
    """
    slots = values.sparkSession.range(size).join(values, F.col("id") == F.col("slot"), "left")
    filled = slots.select("id", F.coalesce("value", default).alias("value"))
    rows = filled.agg(F.sort_array(F.collect_list(F.struct("id", "value"))).alias("rows"))
    return rows.select(F.transform("rows", lambda row: row["value"]).alias("values")).scalar()


def maybe_in(key: Column, keys: DataFrame, bits: int = FILTER_BITS) -> Column:
    """False only where ``key`` is surely not among the one column of ``keys``.

    A bit table of fixed size; with more keys it passes more rows, never fewer. An
    exact join has to follow.
    """
    name = keys.columns[0]
    bit = F.pmod(F.xxhash64(F.col(name)), F.lit(bits)).alias("bit")
    words = (
        keys.select(bit)
        .select(
            F.expr("shiftright(bit, 6)").alias("slot"),
            F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"),
        )
        .groupBy("slot")
        .agg(F.bit_or("mask").alias("value"))
    )
    table = dense_array(words, bits // 64, F.lit(0).cast("long"))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    word = F.get(table, F.shiftright(place, 6).cast("int"))
    low = F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int"))
    return low.bitwiseAND(F.lit(1).cast("long")) == 1


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Alternates large-star and small-star rounds until no edge changes, so the rounds grow
    with the logarithm of a component's size, and every round moves each edge a bounded
    number of times. The edges of a hub are never gathered: its minimum is a grouped
    aggregate, and the join on the hub may be split.
    """
    edges = stored(
        links.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).where("u <> v").distinct()
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)).distinct())
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour (or itself)."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m"))
    return moved.union(least.select("u", "m")).toDF("u", "v")


def without(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``key`` is among those of ``gone``, null like any other.

    The bit table passes most rows on as they are; only the others are shuffled for the
    exact join.
    """
    name = fresh("gone", docs)
    keys = stored(gone.select(F.col(key).alias(name)).distinct())
    suspect = maybe_in(F.col(key), keys)
    checked = docs.where(suspect).join(keys, F.col(key).eqNullSafe(F.col(name)), "left_anti")
    return docs.where(~suspect).unionByName(checked)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows: a row here is a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
