"""Quotation linking: who replies to whom in conversations, told by what messages quote.

A line is quoted at the level of its leading ``>`` marks (blanks between them don't count). Adjacent
lines of one level form a passage. Passages are normalised (lower case, white space as one space, ends
trimmed) and hashed, whole and line by line; so are the own words of messages, whole, by paragraph and
by line. A quoted unit belongs to the latest earlier message of its conversation with the same hash, a
passage to the message that accounts for most of its characters (the later one on a tie), and a message
replies to what its outermost linked passage belongs to; without one, to the message before it.

Replies that continue the message before them form a branch; a reply to an earlier message opens one.
Roots and depths are found by pointer doubling over branches, whose number is that of such jumps, and
each message takes its own from its branch. Depth and root order a conversation by reply.

Only DataFrame functions are used. Nothing is ordered over a whole conversation in one task: positions are counted
within ranges of the messages in order, whatever their turns are, "latest before" and branch starts found within
blocks of BLOCK neighbours, then each over one row per block.
Nor are quoted units and originals of a hash paired up: each unit looks up one message.

Defined cases: a null conversation is a conversation; a null turn comes before all others; equal turns
are ordered by role, then text; repeated rows are messages of their own; null texts are empty; blank passages link to
nothing; a very long text is one row, and its lines become rows; other columns are not kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: Neighbours of a conversation that are ordered in one group.
BLOCK = 1024

_MARKS = "^((?:[ \\t]*>)+)[ \\t]?"


def level(line: Column | str) -> Column:
    """Number of quotation marks that a line begins with."""
    marks = F.regexp_extract(line, _MARKS, 1)
    return F.length(marks) - F.length(F.translate(marks, ">", ""))


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, "\\s+", " ")))


def own_words(text: Column) -> Column:
    """A message without its quoted lines."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(_MARKS)), "\n")


def latest_before(rows: DataFrame, keys: list[str], order: str, value: str, out: str, inclusive: bool = False) -> DataFrame:
    """``rows`` with the last non-null ``value`` at a smaller ``order`` (a non-negative long) for the same ``keys``."""
    blocked = rows.withColumn("_block", F.floor(F.col(order) / BLOCK))
    reach = -1 if not inclusive else 0
    # Rows of one order see only rows of a smaller one, or each other too if inclusive.
    within = Window.partitionBy(*keys, "_block").orderBy(order).rangeBetween(Window.unboundedPreceding, reach)
    near = blocked.withColumn("_near", F.last(value, ignorenulls=True).over(within))
    ends = blocked.where(F.col(value).isNotNull()).groupBy(*keys, "_block").agg(F.max_by(value, order).alias("_end"))
    every = blocked.select(*keys, "_block").distinct().join(
        ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), "_end"),
        _same([(k, f"_{k}") for k in keys] + [("_block", "_b")]), "left",
    ).select(*keys, "_block", "_end")
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    far = every.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), F.last("_end", ignorenulls=True).over(earlier).alias("_far")
    )
    return near.join(far, _same([(k, f"_{k}") for k in keys] + [("_block", "_b")]), "left").select(
        *rows.columns, F.coalesce("_near", "_far").alias(out)
    )


def _same(pairs: list[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def positions(messages: DataFrame, scratch: str) -> DataFrame:
    """``messages`` (``conv, turn, role, text``) with ``pos``, from 0 in each conversation.

    Blocks are Spark's ranges of all messages in order, which split by a number of their own even messages that
    are equal in everything; rows are counted within a range, and ranges of a conversation added up.
    """
    order = ["turn", "role", "text"]
    ranged = messages.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("conv", *order, "_tie")
    blocked = materialise(ranged.drop("_tie").withColumn("_block", F.spark_partition_id()), f"{scratch}/blocked")
    within = Window.partitionBy("conv", "_block").orderBy(*order)
    counts = blocked.groupBy("conv", "_block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("conv").alias("_conv"), F.col("_block").alias("_b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return (
        blocked.withColumn("_in", F.row_number().over(within) - 1)
        .join(before, _same([("conv", "_conv"), ("_block", "_b")]))
        .select(*messages.columns, (F.col("before") + F.col("_in")).cast("long").alias("pos"))
    )


def passages(placed: DataFrame) -> DataFrame:
    """Quoted passages: ``conv, pos, passage, level, text, lines`` (normalised lines)."""
    quoting = placed.where(F.col("text").rlike("(?m)" + _MARKS))
    lines = quoting.select("conv", "pos", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).select(
        "conv", "pos", "i", level(F.col("line")).alias("level"), F.regexp_replace("line", _MARKS, "").alias("line")
    )
    order = Window.partitionBy("conv", "pos").orderBy("i")
    starts = lines.withColumn("new", (~F.col("level").eqNullSafe(F.lag("level").over(order))).cast("int"))
    runs = starts.withColumn("passage", F.sum("new").over(order)).where("level > 0")
    return runs.groupBy("conv", "pos", "passage", "level").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias("lines")
    ).select(
        "conv", "pos", "passage", "level", normal(F.array_join("lines", "\n")).alias("text"),
        F.filter(F.transform("lines", normal), lambda x: x != "").alias("lines"),
    ).where("text <> ''")


def links(placed: DataFrame) -> DataFrame:
    """``conv, pos, passage, level, source``: position of the message that a passage comes from (null: none)."""
    quoted = passages(placed)
    units = quoted.select(
        "conv", "pos", "passage", "level", F.explode(F.concat(F.array("text"), F.col("lines"))).alias("unit")
    ).select("conv", "pos", "passage", "level", F.length("unit").alias("size"), F.xxhash64("unit").alias("h"))
    own = own_words(F.col("text"))
    said = placed.select("conv", "pos", F.explode(F.array_distinct(F.transform(
        F.concat(F.array(own), F.split(own, "\\n\\s*\\n"), F.split(own, "\n")), normal
    ))).alias("unit")).where("unit <> ''").select("conv", "pos", F.xxhash64("unit").alias("h"))
    asked = units.select(F.col("conv").alias("_conv"), F.col("h").alias("_h")).distinct()
    said = said.join(asked, _same([("conv", "_conv"), ("h", "_h")]), "left_semi")
    none = F.lit(None)
    both = said.select(
        "conv", "h", "pos", none.cast("int").alias("size"), none.cast("long").alias("passage"), none.cast("int").alias("level"),
        F.col("pos").alias("said"),
    ).unionByName(units.select("conv", "h", "pos", "size", "passage", "level", none.cast("long").alias("said")))
    found = latest_before(both, ["conv", "h"], "pos", "said", "source").where("size IS NOT NULL")
    scored = found.groupBy("conv", "pos", "passage", "level", "source").agg(F.sum("size").alias("score"))
    best = F.max(F.when(F.col("source").isNotNull(), F.struct("score", "source")))
    return scored.groupBy("conv", "pos", "passage", "level").agg(best.alias("best")).select(
        "conv", "pos", "passage", "level", F.col("best.source").alias("source")
    )


def reply_order(messages: DataFrame, scratch: str) -> DataFrame:
    """Conversations by reply, without quotes.

    ``messages``: ``conv, turn, role, text``. Gives these (``text`` without quotes) with ``pos``,
    ``reply_to`` and ``root`` (positions), ``depth``, ``n_passages`` and ``n_linked``.
    """
    placed = materialise(
        positions(messages.select("conv", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")), scratch),
        f"{scratch}/placed",
    )
    linked = links(placed)
    first = F.min(F.when(F.col("source").isNotNull(), F.struct("level", "passage", "source")))
    per_message = linked.groupBy(F.col("conv").alias("_conv"), F.col("pos").alias("_pos")).agg(
        F.count("*").alias("n_passages"), F.count("source").alias("n_linked"), first.alias("first")
    )
    rows = placed.select("conv", "pos").join(per_message, _same([("conv", "_conv"), ("pos", "_pos")]), "left").select(
        "conv", "pos", F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce(F.col("first.source"), F.when(F.col("pos") > 0, F.col("pos") - 1)).alias("reply_to"),
    )
    jump = F.col("reply_to").isNull() | (F.col("reply_to") < F.col("pos") - 1)
    rows = materialise(
        latest_before(rows.withColumn("start", F.when(jump, F.col("pos"))), ["conv"], "pos", "start", "branch", inclusive=True),
        f"{scratch}/rows",
    )
    # A branch hangs on a message of an earlier branch: `up` and the steps from its first message to that one's.
    starts = rows.where("start IS NOT NULL AND reply_to IS NOT NULL").select("conv", F.col("branch").alias("b"), "reply_to")
    parents = rows.select(F.col("conv").alias("_conv"), F.col("pos").alias("_pos"), F.col("branch").alias("up"))
    tree = materialise(
        starts.join(parents, _same([("conv", "_conv"), ("reply_to", "_pos")])).select(
            "conv", "b", "up", (F.col("reply_to") - F.col("up") + 1).alias("steps")
        ),
        f"{scratch}/tree0",
    )
    i, moved = 0, tree.count()
    while moved:  # each round doubles the branches that a pointer passes over
        i += 1
        above = tree.select(F.col("conv").alias("_conv"), F.col("b").alias("_b"), F.col("up").alias("next"), F.col("steps").alias("more"))
        joined = tree.join(above, _same([("conv", "_conv"), ("up", "_b")]), "left")
        tree = materialise(
            joined.select(
                "conv", "b", F.coalesce("next", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("moved"),
            ),
            f"{scratch}/tree{i}",
        )
        moved = tree.where("moved").count()
    above = tree.select(F.col("conv").alias("_conv"), F.col("b").alias("_b"), F.col("up").alias("root"), "steps")
    deep = rows.join(above, _same([("conv", "_conv"), ("branch", "_b")]), "left").select(
        F.col("conv").alias("_c"), F.col("pos").alias("_p"), "reply_to", "n_passages", "n_linked",
        F.coalesce("root", "branch").alias("root"),
        (F.coalesce("steps", F.lit(0)) + F.col("pos") - F.col("branch")).alias("depth"),
    )
    return placed.join(deep, _same([("conv", "_c"), ("pos", "_p")])).select(
        "conv", "turn", "role", own_words(F.col("text")).alias("text"), "pos", "reply_to", "root", "depth", "n_passages", "n_linked"
    )
