"""Chat formatting as a prefix tree: turns that conversations share at their start are emitted once, depth first.

Tokens are the code points of the formatted text. Every turn becomes

    <turn ROLE>TEXT</turn>\\n

with ROLE and TEXT escaped: \\ as \\b, < as \\l, > as \\g; so no text can hold a control string, and escaping is undone by reading \\l, \\g and \\b back in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, numbered, with_offsets

OPEN, MIDDLE, CLOSE = "<turn ", ">", "</turn>\n"
#: Tokens of the stream by which nodes and intervals meet; the result does not depend on it.
BLOCK = 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def turns(conversations: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, depth (from 0), node (digest of the formatted turns up to it, that is, its place in the tree), role, text, formatted, size.

    Turns are ordered by turn, role and text; null roles and texts are empty. Rows with a null conv_id are left out.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    formatted = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE))
    # each text travels once; formatted texts and the digests of paths are made where a conversation is together
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    lists = lists.withColumn("said", F.transform("all", formatted))
    chain = F.aggregate("said", F.array(F.lit("")), lambda a, t: F.array_append(a, F.sha2(F.concat(F.element_at(a, -1), F.sha2(t, 256)), 256)))
    out = lists.withColumn("chain", chain).select("conv_id", F.posexplode(F.arrays_zip("all", "said", F.slice("chain", F.lit(2), F.size("all")).alias("node"))).alias("depth", "t"))
    return out.select("conv_id", "depth", F.col("t.node").alias("node"), F.col("t.all.role").alias("role"), F.col("t.all.text").alias("text"), F.col("t.said").alias("formatted"), F.length("t.said").cast("long").alias("size"))


def build(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, members).

    nodes, a row for each turn of the tree: node, depth, emitted (first token's place in the depth-first stream), position (its position id: tokens of the turns above), size, loss (an assistant's turn), loss_from and loss_to (places in formatted that bear loss), formatted, attends (from and to in the stream, ascending, of all turns above, adjacent ones as one interval, and last of its own; tokens see those intervals up to themselves).
    members, a row for each turn of each conversation: conv_id, depth, node, emitted, size.
    Both are written out whole.

    Conversations in the order of their paths (the digests from the first turn on; equal ones by conv_id) are the leaves from left to right. A node belongs to the first conversation that has it, found by a minimum over ranks that each task takes beforehand; a conversation emits what belongs to it, the end of its path. Two-pass prefix sums give ranks and places. A first turn that a third of all conversations share is one row a task in the minimum, and a skewed join, not a group, elsewhere.
    Turns above are adjacent in the stream as long as one conversation emits them, so their intervals grow with the branches a conversation takes, not with its turns.
    An empty table gives empty results; repeated conversations share all nodes.
    """
    found = materialize(turns(conversations).drop("text"), "turns")
    paths = found.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: F.substring(x["node"], 1, 16)), "").alias("path"), F.sum("size").alias("total"))
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", F.lit(1).cast("long").alias("one"))
    ranks = with_offsets(numbered(ordered, "one", "ranks"), "one", "rank").select("conv_id", "rank")
    above = F.coalesce(F.sum("size").over(Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = materialize(found.select("conv_id", "depth", "node", "size").withColumn("position", above).join(ranks, "conv_id"), "placed")
    owners = materialize(placed.groupBy("node").agg(F.min("rank").alias("owner")), "owners")
    own = materialize(placed.join(owners, "node"), "own")
    emits = own.where("rank = owner").groupBy("rank").agg(F.min("position").alias("first"), F.sum("size").alias("emits"))
    stream = emits.repartitionByRange("rank").sortWithinPartitions("rank")
    shift = with_offsets(numbered(stream, "emits", "stream"), "emits", "place").select(F.col("rank").alias("owner"), (F.col("place") - F.col("first")).alias("shift"))
    members = materialize(own.join(shift, "owner").withColumn("emitted", F.col("position") + F.col("shift")).drop("shift"), "members")
    way = Window.partitionBy("conv_id").orderBy("depth")
    end = F.lag(F.col("emitted") + F.col("size")).over(way)
    # only where the stream does not go on from the turn above does a list get longer
    leaps = members.withColumn("end", end).withColumn("leap", F.col("end").isNull() | (F.col("end") != F.col("emitted")))
    so_far = way.rowsBetween(Window.unboundedPreceding, 0)
    lists = leaps.withColumn("froms", F.collect_list(F.when(F.col("leap"), F.col("emitted"))).over(so_far)).withColumn("tos", F.collect_list(F.when(F.col("leap"), F.col("end"))).over(so_far))
    interval = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    start = F.element_at("froms", -1)
    open_one = F.when(start < F.col("emitted"), F.array(interval(start, F.col("emitted")))).otherwise(F.array())
    closed = F.zip_with(F.slice("froms", F.lit(1), F.size("tos")), "tos", interval)
    mine = lists.where("rank = owner").withColumn("attends", F.concat(closed, open_one, F.array(interval(F.col("emitted"), F.col("emitted") + F.col("size")))))
    texts = found.select("conv_id", "depth", "role", "formatted")
    head = F.length(F.lit(OPEN)) + F.length(escape(F.col("role"))) + F.length(F.lit(MIDDLE))
    nodes = mine.join(texts, ["conv_id", "depth"]).select(
        "node", "depth", "emitted", "position", "size", (F.col("role") == "assistant").alias("loss"), head.alias("loss_from"), (F.length("formatted") - F.length(F.lit(CLOSE))).alias("loss_to"), "formatted", "attends"
    )
    return materialize(nodes, "nodes"), members.select("conv_id", "depth", "node", "emitted", "size")


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Conversations from the output alone: conv_id, formatted, and turns (array of position, depth, role, text, loss_text and formatted) in order.

    A conversation is what its last token sees: the intervals that its last turn attends to, read from the stream in the order of position ids. Members only say where that turn is. Intervals meet nodes by blocks of the stream.
    """
    last = members.groupBy("conv_id").agg(F.max_by("emitted", "depth").alias("emitted"))
    seen = last.join(nodes.select("emitted", "attends"), "emitted").select("conv_id", F.explode("attends").alias("i")).select("conv_id", F.col("i.from").alias("from"), F.col("i.to").alias("to"))
    block = lambda at: F.floor(at / BLOCK)
    blocks = seen.withColumn("block", F.explode(F.sequence(block(F.col("from")), block(F.col("to") - 1))))
    stream = nodes.select(block(F.col("emitted")).alias("block"), "emitted", "position", "depth", "formatted", "loss", "loss_from", "loss_to")
    rows = blocks.join(stream, (blocks["block"] == stream["block"]) & (F.col("emitted") >= F.col("from")) & (F.col("emitted") < F.col("to")))
    # formatted texts alone are gathered; what they hold is taken apart afterwards
    turn = F.struct("position", "depth", "formatted", "loss", "loss_from", "loss_to")
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("seen"))

    def apart(t: Column) -> Column:
        role = F.regexp_extract(t["formatted"], r"(?s)\A<turn ([^>]*)>", 1)
        text = F.regexp_extract(t["formatted"], r"(?s)\A<turn [^>]*>(.*)</turn>\n\z", 1)
        masked = F.when(t["loss"], t["formatted"].substr(t["loss_from"] + 1, t["loss_to"] - t["loss_from"])).otherwise("")
        return F.struct(t["position"].alias("position"), t["depth"].alias("depth"), unescape(role).alias("role"), unescape(text).alias("text"), unescape(masked).alias("loss_text"), t["formatted"].alias("formatted"))

    return gathered.select("conv_id", F.transform("seen", apart).alias("turns"), F.array_join(F.transform("seen", lambda t: t["formatted"]), "").alias("formatted"))


def digests(read: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("turns", lambda t: t["loss_text"]), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
