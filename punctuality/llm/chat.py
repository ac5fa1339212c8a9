"""Reply trees to conversations, with DataFrame functions alone.

**Paths.** A message knows its parent. Pointers are doubled by self-joins: after round r a message knows its ancestor
2^r steps up and the sum of scores on the way, so a tree of depth d takes log2(d) rounds over rows that do not multiply.
Leaves are ranked by the mean score of their branch. Only chosen leaves are spread to the messages of their path, again
by doubling.

**Text.** A turn is ``<s>role\\n text</s>\\n``. Control strings inside a role or text are broken by a backslash after their
first character, and backslashes are doubled, so that no control string occurs but the template's own and every text
can be read back. The loss mask is a list of spans over the formatted text: one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import stored

OPEN, CLOSE = "<s>", "</s>\n"
#: Strings that chat models take for control: they never occur in an escaped text.
CONTROL = "(<)(/?s>|\\|)|(\\[)(/?INST\\])|(<<)(/?SYS>>)"
LEARNED_ROLE = "assistant"
MAX_ROUNDS = 40


def escape(text: Column) -> Column:
    """``text`` without any control string; ``unescape`` gives it back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, "$1$3$5\\\\$2$4$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role in one line: a line break in it is written as a backslash and a carriage return."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\r"))


def unescape_role(role: Column) -> Column:
    """The inverse; an even number of backslashes before the mark are doubled ones and do not belong to it."""
    return unescape(F.regexp_replace(role, "(?<!\\\\)((?:\\\\\\\\)*)\\\\\r", "$1\n"))


def read_turns(formatted: Column) -> Column:
    """Array of structs (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, "</s>\n")
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        head = F.instr(part, "\n")
        role = F.substring(part, F.lit(len(OPEN) + 1), head - len(OPEN) - 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substring(part, head + 1, F.length(part))).alias("text"),
        )

    return F.transform(whole, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """Texts under the loss mask, read back, with nothing between them."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def as_tree(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each turn answers the one before. Equal turn numbers follow role and text."""
    order = Window.partitionBy(F.col(conversation)).orderBy(turn, role, text)
    number = F.row_number().over(order).cast("long")
    held = rows.select(F.col(conversation).alias("conversation"), F.col(role).alias("role"), F.col(text).alias("text"), number.alias("node"))
    return held.withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})


def _key(name: str) -> list[Column]:
    """Null is a conversation like any other; a join needs a value for it."""
    return [F.coalesce(F.col("conversation").cast("string"), F.lit("")).alias("c"), F.col("conversation").isNull().alias("c_null"), F.col(name)]


def branches(tree: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves ``(c, c_null, node, depth, score)`` and, for each power of two, the ancestors ``(c, c_null, node, up)``."""
    edges = tree.select(*_key("node"), F.col("parent").alias("up"), F.coalesce("score", F.lit(0.0)).alias("sum"), F.lit(1).cast("long").alias("depth"))
    state = stored(edges, "tree")
    inner = state.select("c", "c_null", F.col("up").alias("node")).filter("node is not null").distinct()
    leaves = state.join(inner, ["c", "c_null", "node"], "left_anti").select("c", "c_null", "node")
    jumps, done = [state.select("c", "c_null", "node", "up")], None
    for _ in range(MAX_ROUNDS):
        if state.filter("up is not null").isEmpty():
            return leaves.join(state.drop("up"), ["c", "c_null", "node"]), jumps
        above = state.select("c", "c_null", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("sum").alias("sum2"), F.col("depth").alias("depth2"))
        live, done = state.filter("up is not null"), state.filter("up is null")  # what has met its root is not joined again
        live = live.join(above, ["c", "c_null", "up"], "left").select(
            "c", "c_null", "node", F.col("up2").alias("up"),
            (F.col("sum") + F.coalesce("sum2", F.lit(0.0))).alias("sum"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
        )
        state = stored(live.unionByName(done), "tree")
        jumps.append(state.select("c", "c_null", "node", "up"))
    raise ValueError(f"a path is longer than 2^{MAX_ROUNDS}, or replies run in a circle")


def format_trees(tree: DataFrame, best: int = 1, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """``(conversation, leaf, rank, n_turns, formatted, loss_spans)``: the ``best`` branches of each conversation.

    ``tree`` has conversation, node (unique in it), parent (null at a root), role, text and score. A branch is scored by
    the mean of its messages, null counting 0; ties go to the longer branch, then to the smaller leaf. A parent that
    does not exist ends the branch there. Null text and role count as empty; a null conversation is one of its own;
    an empty table gives no rows; further columns are ignored. Replies in a circle have no leaf and give no row.
    """
    leaves, jumps = branches(tree)
    order = Window.partitionBy("c", "c_null").orderBy((F.col("sum") / F.col("depth")).desc(), F.col("depth").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    spread = chosen.select("c", "c_null", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("above"))
    for r, jump in enumerate(jumps):
        known = jump.filter("up is not null").select("c", "c_null", "node", "up")
        more = spread.join(known, ["c", "c_null", "node"]).select("c", "c_null", "leaf", "rank", F.col("up").alias("node"), (F.col("above") + 2**r).alias("above"))
        spread = stored(spread.unionByName(more), "paths")  # else each round would hold the plan before it twice
    said = tree.select(*_key("node"), "conversation", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = spread.join(said, ["c", "c_null", "node"]).select(
        "c", "c_null", "conversation", "leaf", "rank", "above", "node", "role", "text",
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"),
    )
    # Where a turn starts is a running sum over its path; the turns are put together once, in the order of their starts.
    size = (F.length("head") + F.length("body") + len(CLOSE)).cast("long")
    path = Window.partitionBy("c", "c_null", "leaf", "rank").orderBy(F.col("above").desc(), "node", "role", "text")
    before = F.coalesce(F.sum(size).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turn = F.struct(
        "start", F.concat("head", "body", F.lit(CLOSE)).alias("written"), (F.col("start") + F.length("head")).alias("body"),
        F.length("body").cast("long").alias("length"), (F.col("role") == learned_role).alias("learned"),
    )
    placed = turns.withColumn("start", before)
    whole = placed.groupBy("c", "c_null", "conversation", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["body"].alias("start"), t["length"].alias("length")))
    return whole.select(
        "conversation", "leaf", "rank", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["written"]), "").alias("formatted"), spans.alias("loss_spans"),
    )
