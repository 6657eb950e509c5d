"""Reply trees as formatted conversations, with DataFrame operations only.

Paths are found by iterative self-joins that double their reach: after k joins every node knows its ancestor 2**k
replies up and the score on the way. Leaves then know the score of their whole branch, the best branch of each
conversation is chosen, and the same tables, joined once each, list the nodes of the chosen branches.

A turn is written as `### Role: text</turn>` and a line end. Inside texts and roles the characters that marks begin
with are escaped (`\\` as `\\\\`, `<` as `\\l`, `#` as `\\h`, and `:` as `\\c` in roles), so no text can hold a mark
and reading back gives every text unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# fixed values: how the usual roles are written; any other role is written after "="
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, codes=(("\\l", "<"), ("\\h", "#"))) -> Column:
    def plain(part: Column) -> Column:
        for coded, char in codes:
            part = F.replace(part, F.lit(coded), F.lit(char))
        return part

    # between escaped backslashes every backslash begins a code
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def shown_role(role: Column) -> Column:
    shown = F.concat(F.lit("="), F.replace(escape(role), F.lit(":"), F.lit("\\c")))
    for name, mark in ROLES.items():
        shown = F.when(role == name, F.lit(mark)).otherwise(shown)
    return shown


def read_role(mark: Column) -> Column:
    other = unescape(F.substring(mark, 2, 1 << 30), (("\\l", "<"), ("\\h", "#"), ("\\c", ":")))
    role = other
    for name, shown in ROLES.items():
        role = F.when(mark == shown, F.lit(name)).otherwise(role)
    return role


def best_paths(nodes: DataFrame) -> DataFrame:
    """(conv_id, node_id, depth) of the best branch of each conversation in `nodes` (conv_id, node_id, parent_id, score).

    A branch is a root-to-leaf path; the best has the highest sum of scores, then the smallest leaf. A node whose
    parent is null or not in the conversation is a root; null scores count as 0. Nodes below a cycle have no root
    and are left out. A repeated node counts once, with its smallest parent and score. A null conv_id is a conversation.
    """
    nodes = nodes.where("node_id is not null").groupBy("conv_id", "node_id").agg(
        F.min(F.struct("parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("n")
    )
    nodes = nodes.select("conv_id", "node_id", F.col("n.parent_id").alias("parent_id"), F.col("n.score").alias("score"))
    parents = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("p"))
    known = nodes.join(parents, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent_id") == F.col("p")), "left")
    reach = stored(known.select("conv_id", "node_id", F.col("p").alias("up"), F.col("score").alias("total"), F.lit(1).alias("steps")), "reach")
    has_reply = reach.where("up is not null").select(F.col("conv_id").alias("c"), F.col("up").alias("p")).distinct()
    leaf = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("p"))

    # nodes that know their root are done and only looked up; the others go on
    done, going, levels = reach.where("up is null"), reach.where("up is not null"), [reach]
    rounds = max(1, reach.count()).bit_length()
    while len(levels) <= rounds and going.limit(1).count():
        known = done.unionByName(going)
        far = known.select(*[F.col(c).alias(f"far_{c}") for c in known.columns])
        met = going.join(far, F.col("conv_id").eqNullSafe(F.col("far_conv_id")) & (F.col("up") == F.col("far_node_id")))
        level = stored(
            met.select(
                "conv_id", "node_id", F.col("far_up").alias("up"),
                (F.col("total") + F.col("far_total")).alias("total"), (F.col("steps") + F.col("far_steps")).alias("steps"),
            ),
            "reach",
        )
        done, going = done.unionByName(level.where("up is null")), level.where("up is not null")
        levels.append(level)
    whole = done.join(has_reply, leaf, "left_anti")
    best = whole.groupBy("conv_id").agg(F.max_by(F.struct("node_id", "steps"), F.struct("total", -F.col("node_id"))).alias("best"))
    path = best.select("conv_id", F.col("best.node_id").alias("node_id"), F.col("best.steps").alias("depth"))
    for k, level in enumerate(levels):
        up = level.where("up is not null").select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "up")
        far = path.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n")))
        more = stored(far.select("conv_id", F.col("up").alias("node_id"), (F.col("depth") - (1 << k)).alias("depth")), "path")
        path = path.unionByName(more)
    return path


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and loss for `turns` (conv_id, position, role, text) in the order of position.

    loss holds the start (from 0) and length, in code points, of each assistant's text as it stands in formatted.
    Null roles and texts count as empty. A conversation is one row of the result, so its turns meet in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    parts = turns.select("conv_id", "position", role.alias("role"), F.concat(F.lit(OPEN), shown_role(role), F.lit(SEP)).alias("mark"), escape(text).alias("body"))
    parts = parts.withColumn("size", F.length("mark") + F.length("body") + len(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("mark"))
    span = F.when(F.col("role") == "assistant", F.struct("start", F.length("body").cast("long").alias("length")))
    out = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("position", F.concat("mark", "body", F.lit(CLOSE)).alias("turn")))).alias("turns"),
        F.array_sort(F.collect_list(span)).alias("loss"),
    )
    return out.select("conv_id", F.array_join("turns.turn", "").alias("formatted"), "loss")


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds turns (role, text) and loss_text, read from formatted and loss alone."""
    blocks = F.split("formatted", CLOSE)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        mark = F.substring_index(block, SEP, 1)
        text = F.substr(block, F.length(mark) + len(SEP) + 1)
        return F.struct(read_role(F.substring(mark, len(OPEN) + 1, 1 << 30)).alias("role"), unescape(text).alias("text"))

    masked = F.transform("loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return conversations.withColumn("turns", F.transform(blocks, turn)).withColumn("loss_text", F.array_join(masked, ""))


def format_conversations(nodes: DataFrame) -> DataFrame:
    """The best branch of each conversation in `nodes` (conv_id, node_id, parent_id, score, role, text), formatted.

    See best_paths and formatted for ties, nulls and repeated nodes. No rows give no rows; other columns are ignored.
    """
    path = best_paths(nodes).toDF("c", "n", "depth")
    said = nodes.groupBy("conv_id", "node_id").agg(F.min(F.struct("role", "text")).alias("s"))
    met = said.join(path, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n")))
    return formatted(met.select("conv_id", F.col("depth").alias("position"), "s.role", "s.text"))


def linear_tree(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a tree in which each turn replies to the one before; equal turns by role, text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("node_id"))
    return rows.select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")
