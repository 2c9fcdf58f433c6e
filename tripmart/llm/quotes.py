"""Quotation linking: messages without quotes, in the order of replies.

Only DataFrame functions. Quoted lines are told by their leading ">" marks; a run of lines
of one level is a passage. Normalised passages are hashed and joined to the messages of
the same conversation that say the same, in any run of their lines, and a message replies
to the latest of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

MARKS = r"^[\x20\t]*(>[\x20\t>]*)"
# The line before a quote that names its author, such as "On Monday Ann wrote:".
ATTRIBUTION = r"(?i)\b(wrote|writes|said|schrieb|\u00e9crit|escribi\u00f3|scritto)[\x20\t]*:[\x20\t]*$"
# A window over the turns that say one thing covers 2 ** TURN_BITS turns at most.
TURN_BITS = 12


def _level(line: Column) -> Column:
    """Number of ">" marks before a line's text."""
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(F.regexp_replace(marks, r"[^>]", ""))


def normalised(text: Column) -> Column:
    """Lower case, letters and digits only, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _said_lines(text: str) -> Column:
    """The normalised lines of a text that say something."""
    lines = F.transform(F.split(text, "\n", -1), normalised)
    return F.filter(lines, lambda line: line != "")


def parsed_messages(messages: DataFrame, attribution: str = ATTRIBUTION) -> DataFrame:
    """``row, conv_id, turn, role, text`` (without quotes), ``passages`` (level, text) and
    ``max_level`` per message; null texts are empty.

    A line that ``attribution`` finds goes with the quote that it stands before, directly
    or above one empty line. Every line is looked at a bounded number of times.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n", -1)
    told = messages.select(
        F.monotonically_increasing_id().alias("row"),
        "conv_id",
        "turn",
        "role",
        F.transform(
            lines,
            lambda line: F.struct(
                _level(line).alias("level"), F.regexp_replace(line, MARKS, "").alias("line")
            ),
        ).alias("lines"),
    )

    def level(i: Column) -> Column:
        return F.get(F.col("lines"), i)["level"]

    def names_author(line: Column, i: Column) -> Column:
        empty = (level(i + 1) == 0) & (F.trim(F.get(F.col("lines"), i + 1)["line"]) == "")
        quoted = (level(i + 1) > 0) | (empty & (level(i + 2) > 0))
        return F.coalesce(quoted, F.lit(False)) & line["line"].rlike(attribution)

    n_lines = F.size("lines")
    places = F.sequence(F.lit(0), n_lines - 1)
    begun = told.withColumn(
        "begins", F.filter(places, lambda i: (i == 0) | (level(i) != level(i - 1)))
    )
    runs = F.transform(
        "begins",
        lambda begin, k: F.struct(
            level(begin).alias("level"),
            F.slice(
                F.col("lines"),
                begin + 1,
                F.coalesce(F.get(F.col("begins"), k + 1), n_lines) - begin,
            ).alias("lines"),
        ),
    )
    passages = F.transform(
        F.filter(runs, lambda run: run["level"] > 0),
        lambda run: F.struct(
            run["level"].alias("level"),
            F.array_join(F.transform(run["lines"], lambda line: line["line"]), "\n").alias("text"),
        ),
    )
    own = F.filter(
        "lines", lambda line, i: (line["level"] == 0) & ~names_author(line, i)
    )
    return begun.select(
        "row",
        "conv_id",
        "turn",
        "role",
        F.trim(F.array_join(F.transform(own, lambda line: line["line"]), "\n")).alias("text"),
        passages.alias("passages"),
        F.array_max(F.transform("lines", lambda line: line["level"])).alias("max_level"),
    )


def _with_runs(rows: DataFrame, longest: int) -> DataFrame:
    """``rows`` with ``runs``: a hash for each run of ``k`` neighbours in ``lines``, in order.

    Runs of 1, 2, 4 and so on are hashed from the halves, and those that add up to ``k`` are
    joined: the work is linear in the lines for each bit of ``longest``, the largest ``k``.
    """
    empty = F.transform("lines", lambda line: F.lit(0).cast("long"))
    rows = rows.select("*", empty.alias("runs"), F.col("lines").alias("powers"))
    for bit in range(longest.bit_length()):
        half = 1 << bit
        done = F.col("k").bitwiseAND(F.lit(half - 1))
        ahead = F.slice("powers", done + 1, F.size("lines"))
        longer = F.zip_with("runs", ahead, lambda run, power: F.xxhash64(run, power))
        has_bit = F.col("k").bitwiseAND(F.lit(half)) != 0
        second = F.slice("powers", F.lit(half + 1), F.size("lines"))
        rows = rows.withColumns(
            {
                "runs": F.when(has_bit, longer).otherwise(F.col("runs")),
                "powers": F.zip_with("powers", second, lambda a, b: F.xxhash64(a, b)),
            }
        )
    whole = F.slice("runs", F.lit(1), F.greatest(F.size("lines") - F.col("k") + 1, F.lit(0)))
    return rows.withColumn("runs", whole).drop("powers")


def _key(kind: str, value: Column) -> Column:
    return F.xxhash64(F.lit(kind), value)


def _quotes(keyed: DataFrame) -> DataFrame:
    """``row, conv_id, turn, level, lines`` (hashed), ``k`` (their number), ``whole`` per passage."""
    passages = keyed.select("row", "conv_id", "turn", F.explode("passages").alias("passage"))
    said = passages.select(
        "row",
        "conv_id",
        "turn",
        F.col("passage.level").alias("level"),
        _said_lines("passage.text").alias("said"),
    ).where(F.size("said") > 0)
    return said.select(
        "row",
        "conv_id",
        "turn",
        "level",
        F.transform("said", lambda line: F.xxhash64(line)).alias("lines"),
        F.size("said").alias("k"),
        F.xxhash64(F.array_join("said", " ")).alias("whole"),
    )


def _originals(keyed: DataFrame, quotes: DataFrame, longest: int) -> DataFrame:
    """``conv_id, turn, hash`` of what messages say: the whole text, its paragraphs, and its
    runs of as many lines as some quote of the conversation has."""
    sizes = quotes.groupBy("conv_id").agg(F.collect_set("k").alias("sizes"))
    paragraphs = F.concat(F.array("text"), F.split("text", r"\n\s*\n"))
    said = (
        keyed.where("text <> ''")
        .join(sizes, "conv_id")
        .select(
            "conv_id",
            "turn",
            "sizes",
            F.transform(_said_lines("text"), lambda line: F.xxhash64(line)).alias("lines"),
            F.filter(F.transform(paragraphs, normalised), lambda p: p != "").alias("paragraphs"),
        )
    )
    fitting = F.filter("sizes", lambda k: k <= F.size(F.col("lines")))
    runs = _with_runs(said.select("conv_id", "turn", "lines", F.explode(fitting).alias("k")), longest)
    # A plain explode would also filter on the array's size, written out for every bit.
    by_run = runs.select("conv_id", "turn", F.explode_outer("runs").alias("run")).select(
        "conv_id", "turn", _key("run", F.col("run")).alias("hash")
    )
    by_text = said.select("conv_id", "turn", F.explode("paragraphs").alias("paragraph")).select(
        "conv_id", "turn", _key("text", F.xxhash64("paragraph")).alias("hash")
    )
    return by_run.union(by_text).distinct()


def _latest_before(asked: DataFrame, said: DataFrame) -> DataFrame:
    """``conv_id, turn, hash, found``: the last turn before ``turn`` that says ``hash``.

    Both tables have distinct ``conv_id, turn, hash``. What is said in thousands of turns is
    never paired: one pass in the order of turns carries the last one on. It goes by
    blocks of turns, so that no task gets all turns that say one frequent thing.
    """
    needed = said.join(asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    events = stored(
        asked.select("conv_id", "hash", "turn", F.lit(None).cast("long").alias("own"))
        .union(needed.select("conv_id", "hash", "turn", F.col("turn").cast("long")))
        .withColumn("block", F.shiftright("turn", TURN_BITS))
    )
    in_block = Window.partitionBy("conv_id", "hash", "block").orderBy(
        "turn", F.col("own").isNotNull()
    )
    near = events.withColumn("near", F.last("own", ignorenulls=True).over(
        in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )).where("own is null")
    blocks = events.groupBy("conv_id", "hash", "block").agg(F.max("own").alias("last"))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    far = blocks.withColumn("far", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    return near.join(far, ["conv_id", "hash", "block"]).select(
        "conv_id", "turn", "hash", F.coalesce("near", "far").alias("found")
    ).where("found is not null")


def reply_threads(messages: DataFrame, attribution: str = ATTRIBUTION) -> DataFrame:
    """``conv_id, turn, role, text, n_quotes, max_level, reply_to, depth, path`` per message.

    ``reply_to`` is the latest earlier turn of the conversation whose own text says a passage
    quoted here at the first level, or else at the first level at which one is known: as its
    whole, as a paragraph, or as neighbouring lines. Without such it is null and the message
    starts a thread. ``path`` has the turns from there on: ordered by conv_id and path, every
    reply follows what it answers. Texts are compared without case, marks and empty lines, by
    64-bit hashes within their conversation. Lines that name a quote's author are dropped.

    Null conversations or turns link with nothing. Repeated turns are messages each, and a
    reply to them follows their turn. An empty table gives none; other columns are dropped.
    Long texts are read whole, in time linear in their lines for each length of a quote.
    """
    parsed = stored(parsed_messages(messages, attribution))
    keyed = parsed.where("conv_id is not null and turn is not null")
    quotes = stored(_quotes(keyed))
    longest = quotes.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]
    run = _key("run", F.get(F.col("runs"), F.lit(0)))
    asking = _with_runs(quotes, longest).select(
        "row",
        "conv_id",
        "turn",
        "level",
        F.explode_outer(F.array(run, _key("text", F.col("whole")))).alias("hash"),
    )
    answers = _latest_before(
        asking.select("conv_id", "turn", "hash").distinct(),
        _originals(keyed, quotes, longest),
    )
    found = (
        asking.join(answers, ["conv_id", "turn", "hash"])
        .groupBy("row")
        .agg(F.max_by("found", F.struct(-F.col("level"), F.col("found"))).alias("reply_to"))
        .withColumn("reply_to", F.col("reply_to").cast(messages.schema["turn"].dataType))
    )
    linked = stored(parsed.join(found, "row", "left"))
    facts = linked.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size("passages").alias("n_quotes"),
        "max_level",
        "reply_to",
    )
    paths = _paths(linked)
    joined = facts.join(
        paths.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "path", "up"),
        F.col("conv_id").eqNullSafe(F.col("c"))
        & F.col("turn").eqNullSafe(F.col("t"))
        & F.col("reply_to").eqNullSafe(F.col("up")),
        "left",
    )
    path = F.coalesce("path", F.array("turn"))
    return joined.select(
        *facts.columns, (F.size(path) - 1).alias("depth"), path.alias("path")
    )


def _paths(linked: DataFrame) -> DataFrame:
    """``conv_id, turn, up, path`` of messages that reply: turns from the thread's start.

    Each round joins a path with that of its first turn, so paths double and the rounds grow
    with the logarithm of a thread's depth. A turn that was said twice goes by its latest
    reply_to.
    """
    hops = linked.where("reply_to is not null").select("conv_id", "turn", "reply_to").distinct()
    above = hops.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("next"))
    paths = stored(
        hops.select(
            "conv_id",
            "turn",
            F.col("reply_to").alias("up"),
            F.col("reply_to").alias("top"),
            F.array("reply_to", "turn").alias("path"),
        )
    )
    jumps = above.select("conv_id", F.col("turn").alias("top"), F.array("next").alias("before"))
    jumps = stored(jumps.withColumn("far", F.get("before", F.lit(0))))
    while True:
        longer = paths.join(jumps, ["conv_id", "top"], "left")
        paths = stored(
            longer.select(
                "conv_id",
                "turn",
                "up",
                F.coalesce("far", "top").alias("top"),
                F.when(F.col("far").isNull(), F.col("path"))
                .otherwise(F.concat("before", "path"))
                .alias("path"),
                F.col("far").isNotNull().alias("moved"),
            )
        )
        if paths.where("moved").isEmpty():
            return paths
        ahead = jumps.select(
            "conv_id",
            F.col("top").alias("far"),
            F.col("before").alias("more"),
            F.col("far").alias("beyond"),
        )
        jumps = stored(
            jumps.join(ahead, ["conv_id", "far"], "left").select(
                "conv_id",
                "top",
                F.when(F.col("beyond").isNull(), F.col("before"))
                .otherwise(F.concat("more", "before"))
                .alias("before"),
                F.coalesce("beyond", "far").alias("far"),
            )
        )
