"""Chat formatting of reply trees, with DataFrame operations only.

Messages name their parent, so each tree holds many conversations: one for every path from its root to
a leaf. Iterative self-joins find them. In round k each message is joined with the message that it
reached in round k - 1 and so reaches its ancestor 2^k above; a tree of depth d takes log2(d) rounds.
On the way, steps to the root and the scores along the path add up. Leaves are ranked in their tree by
the score of their branch, and the rounds are then walked backwards for the chosen leaves only: a path
that holds a message takes in the message 2^k above it. Each round is written, which cuts the lineage.

A chosen path is formatted as one conversation by a template that escapes its own marks inside texts, so
that turns, texts and the spans under the loss mask can be read back from the formatted text alone.

Defined results: null text and null role are empty; messages of a null tree are one tree; a message
without a key is left out, as nothing can refer to it; of messages with one key in one tree the least
(parent, role, text, score) counts; a parent that does not exist makes its child a root; messages on or below a
cycle reach no root and are on no path; a null score counts as 0; branches of equal score rank by
their leaf's key; an empty table gives no rows. Other columns of the input are not read. One formatted
conversation is one value, so one path is held by one task; nothing else is gathered.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.session import materialise

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """A turn is ``head role between text end`` and a line end.

    Marks must not hold the escape sign and must not overlap one another, so that none can arise where
    an escaped text meets a mark.
    """

    head: str = "### "
    between: str = ": "
    end: str = "</turn>"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = (self.head, self.between, self.end)
        if any(len(mark) < 2 or ESCAPE in mark for mark in marks):
            raise ValueError("a mark has two characters at least and no escape sign")
        for a, b in product(marks, marks):
            if any(a.endswith(b[:n]) for n in range(1, len(b))) or (a != b and a in b):
                raise ValueError(f"the marks {a!r} and {b!r} overlap")

    def escaped(self, text: Column, *more: str) -> Column:
        """``text`` without marks: the escape sign is doubled and stands behind the first character of each mark."""
        result = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
        for mark in (self.head, self.end, *more):
            result = F.replace(result, F.lit(mark), F.lit(mark[0] + ESCAPE + mark[1:]))
        return result

    @staticmethod
    def plain(text: Column) -> Column:
        """The text before ``escaped``."""
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def opened(self, role: Column) -> Column:
        return F.concat(F.lit(self.head), self.escaped(role, self.between), F.lit(self.between))

    def turns(self, formatted: Column) -> Column:
        """``array<struct<role, text>>`` of a formatted conversation."""
        pieces = F.split(formatted, f"\\Q{self.end}\n\\E", -1)
        known = F.slice(pieces, 1, F.size(pieces) - 1)

        def turn(piece: Column) -> Column:
            role = F.substring_index(piece, self.between, 1)
            return F.struct(
                self.plain(F.substr(role, F.lit(len(self.head) + 1))).alias("role"),
                self.plain(F.substr(piece, F.char_length(role) + len(self.between) + 1)).alias("text"),
            )

        return F.transform(known, turn)

    def learned_texts(self, formatted: Column, loss: Column) -> Column:
        """``array<string>``: the unescaped texts under the loss mask."""
        return F.transform(loss, lambda span: self.plain(F.substr(formatted, span["start"] + 1, span["end"] - span["start"])))


def _joined(left: DataFrame, right: DataFrame, at: str, how: str = "inner") -> DataFrame:
    """``left`` with the row of ``right (_tree, _node, ...)`` whose message ``at`` names; trees may be null."""
    return left.join(right, left["tree"].eqNullSafe(right["_tree"]) & (left[at] == right["_node"]), how).drop("_tree", "_node")


class Trees:
    """Reply trees of a table of messages; ``score`` is the name of a numeric column, or None for one per message."""

    def __init__(
        self, messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text", score: str | None = None
    ):
        points = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(1.0)
        chosen = messages.filter(F.col(node).isNotNull()).select(
            F.col(tree).alias("tree"),
            F.col(node).alias("node"),
            F.struct(
                F.col(parent).alias("parent"),
                F.coalesce(role, F.lit("")).alias("role"),
                F.coalesce(text, F.lit("")).alias("text"),
                points.alias("score"),
            ).alias("_m"),
        )
        single = chosen.groupBy("tree", "node").agg(F.min("_m").alias("_m"))
        self.messages = materialise(single.select("tree", "node", "_m.*"), "tree-messages")

    def _climbed(self) -> tuple[list[DataFrame], DataFrame]:
        """The jumps of each round, and every message that reaches a root with its steps there and the score of its path.

        Only messages that are not at a root yet take part in a round. A jump that is still open after as many rounds as the number of messages has digits runs in a cycle.
        """
        known = self.messages.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.col("node").alias("jump"))
        at = _joined(self.messages.select("tree", "node", "parent", "score"), known, "parent", "left")
        at = materialise(at.select("tree", "node", "jump", F.when(F.col("jump").isNull(), 0).otherwise(1).cast("bigint").alias("steps"), "score"), "tree-jumps")
        rounds, most = [], self.messages.count().bit_length()
        reached, open_ = at.filter("jump IS NULL"), at.filter("jump IS NOT NULL")
        while not open_.isEmpty():
            rounds.append(open_.select("tree", "node", "jump"))
            if len(rounds) > most:
                break
            far = reached.union(open_).select(*(F.col(name).alias(f"_{name}") for name in at.columns))
            step = _joined(open_, far, "jump").select(
                "tree", "node", F.col("_jump").alias("jump"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("score") + F.col("_score")).alias("score")
            )
            step = materialise(step, "tree-jumps")
            reached, open_ = reached.union(step.filter("jump IS NULL")), step.filter("jump IS NOT NULL")
        return rounds, reached

    def paths(self, branches: int = 1) -> DataFrame:
        """``(tree, leaf, rank, score, node, step)``: the messages, from the root on, of each tree's best branches."""
        rounds, reached = self._climbed()
        parents = self.messages.select(F.col("tree").alias("_tree"), F.col("parent").alias("_node")).filter("_node IS NOT NULL").distinct()
        leaves = reached.join(parents, reached["tree"].eqNullSafe(parents["_tree"]) & (reached["node"] == parents["_node"]), "left_anti")
        best = Window.partitionBy("tree").orderBy(F.desc("score"), F.asc("node"))
        ranked = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
        held = materialise(ranked.select("tree", F.col("node").alias("leaf"), "rank", "score", "node", F.col("steps").alias("step")), "tree-paths")
        for k in reversed(range(len(rounds))):
            jumps = rounds[k].select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "jump")
            above = _joined(held, jumps, "node").select("tree", "leaf", "rank", "score", F.col("jump").alias("node"), F.expr(f"step - {1 << k}L").alias("step"))
            held = held.union(materialise(above, "tree-paths"))
        return held

    def conversations(self, branches: int = 1, template: Template = Template()) -> DataFrame:
        """``(tree, leaf, rank, score, n_turns, formatted, loss)``: one row per chosen branch.

        ``loss`` holds the spans (start, end in code points, end exclusive) of the learned roles' escaped texts.
        """
        texts = self.messages.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "role", "text")
        turns = _joined(self.paths(branches), texts, "node")
        opened, inner = template.opened(F.col("role")), template.escaped(F.col("text"))
        turns = turns.withColumn("_open", opened).withColumn("_inner", inner).withColumn("piece", F.concat("_open", "_inner", F.lit(template.end + "\n")))
        before = Window.partitionBy("tree", "leaf").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        turns = turns.withColumn("begin", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("_open"))
        span = F.when(
            F.col("role").isin(*template.learned), F.struct(F.col("begin").alias("start"), (F.col("begin") + F.char_length("_inner")).alias("end"))
        )
        gathered = turns.groupBy("tree", "leaf").agg(
            F.first("rank").alias("rank"),
            F.first("score").alias("score"),
            F.count("*").alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("step", "piece"))).alias("_pieces"),
            F.sort_array(F.collect_list(span)).alias("loss"),
        )
        return gathered.select("tree", "leaf", "rank", "score", "n_turns", F.array_join(F.col("_pieces")["piece"], "").alias("formatted"), "loss")


def chained(messages: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations without branches as reply trees ``(tree, node, parent, role, text)``: a turn replies to the one before it.

    Turns follow ``turn`` (null first), and equal turns role and text.
    """
    order = Window.partitionBy("tree").orderBy("_turn", "role", "text")
    rows = messages.select(
        F.col(tree).alias("tree"), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    numbered = rows.withColumn("node", F.row_number().over(order).cast("bigint"))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text")
