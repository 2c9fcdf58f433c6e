"""Near-duplicate texts by a chosen-path similarity join on their shingle sets.

Texts with equal sets form a class first. Classes descend several independent trees: a
node picks a few coordinates of the minwise signature, and each gives a child per value
there. Nodes that are small enough are compared exhaustively, larger ones branch on.
Candidates pass a test on signatures and are confirmed on full sets.

Only what can join two components is compared: first each node's members with its
smallest one, then, in blocks, members outside a node's main component with the others.
So a group of thousands of near copies never has its pairs written out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import components, maybe_in, numbered, stored, without

COORDINATES = 64
BRANCHES = 2
FIRST_DEPTH, LAST_DEPTH = 3, 8
# A node of so many classes is compared exhaustively; also the side of a block.
NODE_LIMIT = 4096
TARGET_RECALL = 0.9999
# Standard deviations of the signature's estimate that the test allows for.
DEVIATIONS = 4.5
SEED = 20


def tree_count(similarity: float, recall: float = TARGET_RECALL) -> int:
    """Trees needed so that a pair at this similarity shares a node with this probability.

    With two branches a pair stays together for ever with the probability p for
    which p = 1 - (1 - similarity * p)^2; trees are independent.
    """
    together = (2 * similarity - 1) / similarity**2
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


# --- texts ------------------------------------------------------------------------


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; the whole text if it has fewer
    words, nothing if it has none. Only A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=size)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - size + 1
    mixed = np.zeros(count, np.uint64)
    for place in range(size):
        mixed = (mixed ^ hashes[place : place + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return (
        random.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1),
        random.integers(0, 1 << 63, COORDINATES, np.uint64),
    )


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minwise value of the set in every coordinate, in blocks of bounded size."""
    times, plus = _multipliers()
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(hashes), 4096):
        block = hashes[start : start + 4096, None] * times + plus
        least = np.minimum(least, (block >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint32).view(np.int32)


def text_prints(docs: DataFrame, size: int, *keep: str) -> DataFrame:
    """``doc_id, keep, n_shingles, cid, signature`` per row; cid, a digest of the set, is null
    for an empty set."""
    names = ["doc_id", *keep]
    kinds = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in names)

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                hashes = shingle_set(text, size)
                if len(hashes):
                    cid = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                    rows.append((len(hashes), cid, signature(hashes)))
                else:
                    rows.append((0, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "cid", "signature"])
            for place, name in enumerate(names):
                out.insert(place, name, batch[name].to_numpy())
            yield out

    schema = f"{kinds}, n_shingles long, cid binary, signature array<int>"
    return docs.select(*names, "text").mapInPandas(prints, schema)


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``cid, hashes``: the packed full set of each row."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [shingle_set(text, size).tobytes() for text in batch["text"]]
            keys = [hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            yield pd.DataFrame({"cid": keys, "hashes": packed})

    return docs.select("text").mapInPandas(sets, "cid binary, hashes binary")


# --- trees ------------------------------------------------------------------------


def _children(node: Column) -> Column:
    """The nodes below ``node`` of a row with ``signature``: a coordinate per branch, chosen
    by the node alone, and the value there."""

    def child(branch: int) -> Column:
        first = F.xxhash64(node, F.lit(SEED))
        step = 1 + F.pmod(F.shiftright(first, 32), F.lit(COORDINATES - 1))
        place = F.pmod(F.pmod(first, F.lit(COORDINATES)) + branch * step, F.lit(COORDINATES))
        return F.xxhash64(node, place, F.get(F.col("signature"), place.cast("int")))

    return F.explode(F.array(*[child(branch) for branch in range(BRANCHES)]))


def _shared(members: DataFrame) -> DataFrame:
    """Members of nodes that hold two or more, with the node's size and smallest member."""
    sizes = members.groupBy("node").agg(F.count("*").alias("n"), F.min("cid").alias("pivot"))
    shared = stored(sizes.where("n > 1"))
    near = members.where(maybe_in(F.col("node"), shared.select("node")))
    return stored(near.join(shared, "node"))


def tree_nodes(classes: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """(node, cid, n, pivot) of all nodes visited and of those that branch no more.

    The first levels branch for all, at any number of classes; then a node larger than the
    limit branches, until the last level, where it stays as it is.
    """
    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(trees).cast("long")))
    members = classes.select("cid", "signature", roots.alias("node"))
    for _ in range(FIRST_DEPTH):
        members = members.select("cid", "signature", _children(F.col("node")).alias("node"))
    members = members.select("node", "cid").distinct()
    visited, ends = [], []
    for depth in range(FIRST_DEPTH, LAST_DEPTH + 1):
        level = _shared(members)
        visited.append(level)
        large = F.col("n") > NODE_LIMIT
        if depth == LAST_DEPTH or level.where(large).isEmpty():
            ends.append(level)
            break
        ends.append(level.where(~large))
        branching = level.where(large).select("node", "cid").join(
            classes.select("cid", "signature"), "cid"
        )
        members = branching.select("cid", _children(F.col("node")).alias("node")).select(
            "node", "cid"
        ).distinct()
    every, last = visited[0], ends[0]
    for more in visited[1:]:
        every = every.union(more)
    for more in ends[1:]:
        last = last.union(more)
    return every, last


# --- candidates -------------------------------------------------------------------


def _least_matches(percent: int) -> int:
    """Equal coordinates that a pair at the threshold has, but for few deviations."""
    share = percent / 100
    deviation = math.sqrt(share * (1 - share) / COORDINATES)
    return math.floor(COORDINATES * (share - DEVIATIONS * deviation))


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) that sizes and signatures allow to be similar."""

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("cid").alias(name),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("signature").alias(f"s_{name}"),
        )

    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    smaller, larger = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    equal = F.aggregate(
        F.zip_with("s_a", "s_b", lambda x, y: F.when(x == y, 1).otherwise(0)),
        F.lit(0),
        lambda total, one: total + one,
    )
    return both.where(100 * smaller >= percent * larger).where(
        equal >= _least_matches(percent)
    ).select("a", "b")


def _mixed_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of nodes (node, cid) that still hold several components, dealt to blocks.

    In each node, members outside its most frequent component are queries against all
    members. Members and queries are split into blocks of the limit's size, and a group
    (node, block, query block) meets in one task. ``root`` is null outside ``roots``.
    """
    placed = members.select("node", "cid").join(
        roots.select(F.col("node").alias("cid"), F.col("root").alias("found")), "cid", "left"
    ).select("node", "cid", F.coalesce("found", "cid").alias("root"))
    counts = placed.groupBy("node", "root").agg(F.count("*").alias("rows"))
    main = counts.groupBy("node").agg(
        F.max_by("root", F.struct("rows", "root")).alias("main"),
        F.sum("rows").alias("n"),
        F.max("rows").alias("most"),
    )
    mixed = main.where("most < n").select(
        "node", "main", "n", (F.col("n") - F.col("most")).alias("m")
    )
    rows = placed.where(maybe_in(F.col("node"), mixed.select("node"))).join(mixed, "node")
    blocks = F.ceil(F.col("n") / NODE_LIMIT).cast("int")
    queries = F.ceil(F.col("m") / NODE_LIMIT).cast("int")
    spread = F.xxhash64("cid", F.lit(SEED))
    data = rows.select(
        "node",
        "cid",
        "root",
        F.lit(False).alias("query"),
        F.pmod(spread, blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), queries - 1)).alias("part"),
    )
    asked = rows.where("root <> main").select(
        "node",
        "cid",
        "root",
        F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.pmod(spread, queries).cast("int").alias("part"),
    )
    return data.union(asked)


BLOCK_KEYS = ["node", "block", "part"]


def _by_block(rows: DataFrame, links: Callable[[pd.DataFrame], Iterator[tuple]]) -> DataFrame:
    """Pairs (a, b) that ``links`` finds in each block.

    A block lies in one partition in one run, so runs are cut where its key changes;
    at most one block is held at a time.
    """

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def found() -> Iterator[pd.DataFrame]:
            block = pd.concat(held, ignore_index=True)
            if block["query"].any():
                rows = list(links(block))
                if rows:
                    yield pd.DataFrame(rows, columns=["a", "b"])

        for batch in batches:
            keys = batch[BLOCK_KEYS]
            starts = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy())
            bounds = [*starts, len(batch)]
            for start, end in zip(bounds, bounds[1:]):
                run = batch.iloc[start:end]
                if held and tuple(held[0][BLOCK_KEYS].iloc[0]) != tuple(run[BLOCK_KEYS].iloc[0]):
                    yield from found()
                    held.clear()
                held.append(run)
        if held:
            yield from found()

    dealt = rows.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)
    return dealt.mapInPandas(pairs, "a binary, b binary")


def _forest(block: pd.DataFrame, fits: Callable[[int], np.ndarray]) -> Iterator[tuple]:
    """Pairs of a query and a member that ``fits`` names, one for each two components
    joined so: as many as the block has members at most."""
    cids = block["cid"].to_numpy()
    labels = pd.factorize(block["root"])[0]
    for query in np.flatnonzero(block["query"].to_numpy()):
        others = fits(query)
        for other in others[labels[others] != labels[query]]:
            if labels[other] != labels[query]:
                yield min(cids[query], cids[other]), max(cids[query], cids[other])
                labels[labels == labels[other]] = labels[query]


def _likely_links(blocks: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between components that sizes and signatures allow to be similar: enough of
    them to join all that such pairs join."""
    least = _least_matches(percent)

    def links(block: pd.DataFrame) -> Iterator[tuple]:
        values = np.stack(block["signature"].to_numpy())
        sizes = block["n_shingles"].to_numpy()

        def fits(query: int) -> np.ndarray:
            low, high = np.minimum(sizes, sizes[query]), np.maximum(sizes, sizes[query])
            near = np.flatnonzero(100 * low >= percent * high)
            return near[(values[near] == values[query]).sum(axis=1) >= least]

        return _forest(block, fits)

    known = blocks.join(classes.select("cid", "n_shingles", "signature"), "cid")
    return _by_block(known, links).distinct()


def _full_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components whose full sets are similar enough."""

    def links(block: pd.DataFrame) -> Iterator[tuple]:
        hashes = [np.frombuffer(packed, np.uint64) for packed in block["hashes"]]
        sizes = np.array([len(one) for one in hashes])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        names, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        marks = np.zeros(len(names), np.int32)

        def fits(query: int) -> np.ndarray:
            own = tokens[starts[query] : starts[query] + sizes[query]]
            marks[own] = 1
            common = np.add.reduceat(marks[tokens], starts)
            marks[own] = 0
            return np.flatnonzero(100 * common >= percent * (sizes + sizes[query] - common))

        return _forest(block, fits)

    return stored(_by_block(blocks.join(sets, "cid"), links).distinct())


def _sets_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``cid, hashes`` of the wanted classes.

    One row of each is read again; a bit table of fixed size lets pass little more than
    these, and only their sets are shuffled.
    """
    wanted = stored(wanted.distinct())
    ids = stored(wanted.join(classes.select("cid", "min_id"), "cid")).select("min_id")
    found = docs.where(maybe_in(F.col("doc_id"), ids))
    return stored(_full_sets(found, size).join(wanted, "cid").dropDuplicates(["cid"]))


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int):
    """Pairs whose full sets are similar enough."""
    pairs = stored(pairs)
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cid")), docs, classes, size)

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for one, two in zip(batch["h_a"], batch["h_b"]):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.loc[keep, ["a", "b"]]

    def side(name: str) -> DataFrame:
        return sets.select(F.col("cid").alias(name), F.col("hashes").alias(f"h_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "h_a", "h_b")
    return stored(both.mapInPandas(similar, "a binary, b binary"))


# --- the operator -----------------------------------------------------------------


def _placed(prints: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``cid, min_id, root`` per class of equal sets: classes that links connect have one
    root, min_id is the smallest doc_id of the class."""
    classes = stored(
        prints.where("cid is not null")
        .groupBy("cid")
        .agg(
            F.min("doc_id").alias("min_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
    )
    every, ends = tree_nodes(classes, tree_count(percent / 100))
    stars = every.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    links = _confirmed(_likely(stars, classes, percent), docs, classes, size, percent)
    roots = stored(components(links))
    likely = _likely_links(_mixed_blocks(ends, roots), classes, percent)
    # Whatever is still to be compared lies within one group of likely links.
    groups = components(likely.union(links)).select(F.col("root").alias("node"), F.col("node").alias("cid"))
    blocks = stored(_mixed_blocks(stored(groups), roots))
    sets = _sets_of(blocks.select("cid"), docs, classes, size)
    links = links.union(_full_links(blocks, sets, percent))
    roots = stored(components(links)).withColumnRenamed("node", "cid")
    return stored(
        classes.select("cid", "min_id").join(roots, "cid", "left").select(
            "cid", "min_id", F.coalesce("root", "cid").alias("root")
        )
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Rows are linked where 100 * intersection >= percent * union of their sets of ``size``-word
    shingles; component_id is the smallest doc_id reachable, and the rows with that id stay.
    A null or empty text has no shingles and is linked with nothing: its component is its
    own id. A null doc_id takes part in links but is no component's id: such a row is kept
    only if nothing in its component has an id (component_id is then null). Repeated rows
    are one class; rows that share the smallest id all stay. Other columns are dropped.
    """
    prints = stored(text_prints(docs, size))
    placed = _placed(prints, docs, size, percent)
    least = placed.groupBy("root").agg(F.min("min_id").alias("component_id"))
    named = placed.join(least, "root").select("cid", "component_id")
    joined = prints.select("doc_id", "n_shingles", "cid").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``, whatever its rows' ids.

    That with the smallest doc_id stays, null ids last, and the first of those that share
    it. Rows without words stay, as they are linked with nothing. All columns stay.
    """
    docs, row = numbered(docs)
    prints = stored(text_prints(docs, size, row))
    placed = _placed(prints, docs, size, percent)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    first = prints.where("cid is not null").groupBy("cid").agg(F.min(order).alias("first"))
    first = first.join(placed.select("cid", "root"), "cid")
    best = first.groupBy("root").agg(F.min("first").alias("best"))
    chosen = first.join(best, "root").select("cid", F.col("best")[row].alias("best"))
    gone = prints.select("cid", row).join(chosen, "cid").where(F.col(row) != F.col("best"))
    return without(docs, gone, row).drop(row)
