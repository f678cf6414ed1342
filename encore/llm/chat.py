"""Reply trees to formatted conversations, with a loss mask.

Messages point to the message they answer. A path from a tree's root to a leaf
is one conversation. Paths are found by iterated self-joins with pointer
doubling: after round k a message knows its ancestor 2^k steps up, with the
number of messages and the score on the way, so a tree of depth d takes log2(d)
rounds and each round's table has at most one row a message. Leaves are ranked
inside their tree by the mean score of their path, and only the chosen leaves
are expanded to their paths: from the longest jump down, every message found so
far is joined to the message that many steps above it, which finds each message
of a path once.

Template: a turn is ``<|turn|>role<|text|>text<|end|>``. Control strings inside
roles and texts (these three, other ``<|name|>`` marks, ``<s>``, ``</s>``,
``[INST]`` and ``[/INST]``) get a backslash behind their first character, one
more where some stand there already; taking one away again restores every
string. So marks in the output are marks of the template, and the output can be
cut into its turns. The loss mask lists the code point spans of the texts of
the learned role.

Bounds: one row holds one formatted conversation, as the result asks. No tree is
gathered: ranks come from a distributed prefix sum, and joins run on written
tables, so AQE can split a message that many paths share.

Defined results: null role or text is empty; a null score counts as none (a path
without scores ranks last); a message whose parent is missing is a root; a
message on or below a circle of replies has no root and is left out; equal
scores rank by the leaf's id; equal ids of one tree are not allowed there (see
``chains`` for rows without ids); an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import materialize
from encore.operators.ranking import exclusive_prefix_sums

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
# A control string: its first character, backslashes, the rest (which holds no first character).
CONTROL = r"([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def chains(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages ``(tree, node, parent, role, text)`` of linear conversations.

    A row answers the row before it in its conversation by ``turn`` (null
    first; equal turns by a digest of role and text, repeated rows one after
    the other). Rows with a null conversation form one of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tree = F.col(conversation).cast("string")
    rows = materialize(
        turns.select(
            F.coalesce(F.concat(F.lit("="), tree), F.lit("")).alias("tree"),
            F.col(turn).alias("_turn"),
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("_digest"),
            role.alias("role"),
            text.alias("text"),
        ),
        "chat_rows",
    )
    # repeated rows are counted, so the sorted table holds no texts
    distinct = materialize(rows.groupBy("tree", "_turn", "_digest").agg(F.count(F.lit(1)).alias("_n")), "chat_keys")
    placed = materialize(exclusive_prefix_sums(distinct, "tree", ["_turn", "_digest"], ["_n"]), "chat_places")
    once = rows.dropDuplicates(["tree", "_turn", "_digest"]).withColumnsRenamed({"tree": "t2", "_turn": "u2", "_digest": "d2"})
    joined = placed.join(
        once, (F.col("tree") == F.col("t2")) & F.col("_turn").eqNullSafe(F.col("u2")) & (F.col("_digest") == F.col("d2"))
    )
    node = F.explode(F.sequence(F.col("_n_before"), F.col("_n_before") + F.col("_n") - 1))
    numbered = joined.select("tree", node.alias("node"), "role", "text")
    return numbered.select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), "role", "text")


def _known_parents(links: DataFrame) -> DataFrame:
    """Links whose parent is a message of the tree; others become roots."""
    there = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    joined = links.join(there, ["tree", "parent"], "left")
    return joined.select("tree", "node", F.when(F.col("_there"), F.col("parent")).alias("parent"), "score")


def _jumps(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``([round k: tree, node, up], reached)``.

    ``up`` is the ancestor 2^k steps above ``node``. ``reached`` has each
    message's path to its root: ``tree, node, n, scored, score``.
    """
    scored = F.col("score").isNotNull().cast("long")
    now = materialize(
        links.select(
            "tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("n"), scored.alias("scored"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        ),
        "chat_jumps",
    )
    messages, rounds, reached = now.count(), [], [now.where(F.col("up").isNull())]
    start = now
    while 2 ** len(rounds) <= messages:
        climbing = now.where(F.col("up").isNotNull())
        if climbing.isEmpty():
            break
        rounds.append(climbing.select("tree", "node", "up"))
        sums = [F.col(f"a.{c}") + F.col(f"b.{c}") for c in ("n", "scored", "score")]
        # the table after round k says what lies 2^k steps above and what is on the way
        now = materialize(
            climbing.alias("a")
            .join(start.alias("b"), (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.node")))
            .select("a.tree", "a.node", "b.up", *[s.alias(c) for s, c in zip(sums, ("n", "scored", "score"))]),
            "chat_jumps",
        )
        reached.append(now.where(F.col("up").isNull()))
        # a message that has reached its root still carries others there
        start = functools.reduce(DataFrame.unionByName, [now, *reached[:-1]])
    return rounds, functools.reduce(DataFrame.unionByName, reached)


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """``tree, leaf, rank, mean_score, node, above`` for each message of each chosen path.

    ``messages``: ``(tree string, node, parent[, score])``, ``node`` unique in
    its tree. ``branches`` keeps a tree's best-ranked leaves, ``None`` all;
    ``above`` is the number of steps from the leaf up to ``node``.
    """
    score = F.col("score").cast("double") if "score" in messages.columns else F.lit(None).cast("double")
    links = materialize(messages.select("tree", "node", "parent", score.alias("score")), "chat_links")
    links = materialize(_known_parents(links), "chat_known")
    rounds, reached = _jumps(links)
    answered = materialize(
        links.where(F.col("parent").isNotNull()).select("tree", F.col("parent").alias("node")).distinct(), "chat_answered"
    )
    mean = F.when(F.col("scored") > 0, F.col("score") / F.col("scored"))
    leaves = materialize(
        reached.join(answered, ["tree", "node"], "left_anti").select(
            "tree", F.col("node").alias("leaf"), mean.alias("mean_score"),
            F.coalesce(-mean, F.lit(float("inf"))).alias("_worst_last"), F.lit(1).cast("long").alias("_one"),
        ),
        "chat_leaves",
    )
    ranked = exclusive_prefix_sums(leaves, "tree", ["_worst_last", "leaf"], ["_one"])
    if branches is not None:
        ranked = ranked.where(F.col("_one_before") < branches)
    chosen = ranked.select("tree", "leaf", F.col("_one_before").alias("rank"), "mean_score")
    found = materialize(
        chosen.select("*", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above")), "chat_paths"
    )
    for k in reversed(range(len(rounds))):
        jump = rounds[k].select("tree", "node", "up")
        higher = materialize(
            found.join(jump, ["tree", "node"]).select(
                "tree", "leaf", "rank", "mean_score", F.col("up").alias("node"), (F.col("above") + 2**k).alias("above")
            ),
            "chat_paths",
        )
        found = found.unionByName(higher)
    return found


def conversations(messages: DataFrame, branches: int | None = None, learned: str = LEARNED) -> DataFrame:
    """One formatted conversation for each chosen path.

    Returns ``tree, leaf, rank, mean_score, n_turns, formatted, loss_mask``;
    ``loss_mask`` lists ``(begin, stop)`` code points of ``formatted``, end
    exclusive, of the texts whose role is ``learned``.
    """
    role, text = (escape(F.coalesce(F.col(c), F.lit(""))) for c in ("role", "text"))
    texts = messages.select(
        "tree", "node", F.concat(F.lit(TURN), role, F.lit(TEXT)).alias("head"), text.alias("body"),
        (F.coalesce(F.col("role"), F.lit("")) == F.lit(learned)).alias("learned"),
    )
    turn = F.struct((-F.col("above")).alias("order"), "head", "body", "learned")
    gathered = (
        paths(messages, branches)
        .join(texts, ["tree", "node"])
        .groupBy("tree", "leaf", "rank", "mean_score")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,stop:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["head"])
        stop = begin + F.length(t["body"])
        span = F.array(F.struct(begin.alias("begin"), stop.alias("stop")))
        spans = F.when(t["learned"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((stop + len(END)).alias("at"), spans.alias("spans"))

    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    mask = F.aggregate("turns", nothing, add)["spans"]
    return gathered.select(
        "tree", "leaf", "rank", "mean_score", F.size("turns").alias("n_turns"), formatted.alias("formatted"), mask.alias("loss_mask")
    )


def parsed(formatted: Column) -> Column:
    """The turns ``(role, text)`` that a formatted conversation holds."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"),
            unescape(F.substring(F.substring_index(p, END, 1), F.length(F.substring_index(p, TEXT, 1)) + len(TEXT) + 1, F.lit(2**31 - 1))).alias("text"),
        ),
    )


def learned_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(loss_mask, lambda s: unescape(F.substring(formatted, s["begin"] + 1, s["stop"] - s["begin"]))), ""
    )
