"""Reply trees: from posts and what they answer to formatted conversations.

Posts are (tree_id, node_id, parent_id, role, text, score). Paths from root to leaf are enumerated by self-joins that
double their reach: after k rounds a post knows its ancestor 2**k above and the scores up to there, so a path of a
thousand posts takes ten joins. Leaves are ranked by the sum of scores on their path (then depth, then node), the
chosen ones walk back up along the same jumps, and every chosen path is formatted as one conversation.

A turn is written as `### role: text </turn>` and a line feed. In roles and texts a backslash stands before every
`\\`, `#`, `<` and (in roles) `:`, so a text can hold no control string, and reading takes the backslashes away again.
The loss mask covers the texts of the assistant, without marks.

The output is one row per turn, in order; a conversation is the concatenation of its rows, which no task has to hold.

Cases: null texts and roles count as empty; a post whose parent is missing is a root; posts in a cycle raise an error, as
they have no root; an empty table gives no rows; other columns are ignored. Turns of a conversation table that repeat
a place are put one after the other, by role and text, repeated rows too; a null conv_id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthbook.llm.common import checkpointed, python_path, table

HEAD, MIDDLE, END = "### ", ": ", " </turn>\n"
LEARNED = "assistant"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]+|\\.)*?) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _linked(posts: DataFrame) -> DataFrame:
    """Posts with parents that exist; score null counts as 0."""
    known = posts.select(F.col("tree_id").alias("t"), F.col("node_id").alias("parent_id_")).distinct()
    rows = posts.select("tree_id", "node_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    joined = rows.join(known, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("parent_id_")), "left")
    return joined.select("tree_id", "node_id", F.col("parent_id_").alias("up"), "score")


def best_paths(posts: DataFrame, per_tree: int | None = None) -> DataFrame:
    """(tree_id, leaf, rank, place, node_id): the posts of the chosen paths; place 0 is the root."""
    links = checkpointed(_linked(posts))
    state = links.select("tree_id", "node_id", "up", "score", F.lit(1).cast("long").alias("depth"))
    jumps, open_before = [], None
    while True:
        open_now = state.where("up is not null").count()
        if not open_now:
            break
        if open_now == open_before:
            raise ValueError(f"{open_now} posts have no root: their parents form a cycle")
        open_before = open_now
        # Posts that have reached their root take no further part.
        going = state.where("up is not null")
        jumps.append(going.select("tree_id", "node_id", "up"))
        above = state.select(
            F.col("tree_id").alias("t"),
            F.col("node_id").alias("n"),
            F.col("up").alias("up_"),
            F.col("score").alias("score_"),
            F.col("depth").alias("depth_"),
        )
        joined = going.join(above, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        moved = joined.select(
            "tree_id",
            "node_id",
            F.col("up_").alias("up"),
            (F.col("score") + F.col("score_")).alias("score"),
            (F.col("depth") + F.col("depth_")).alias("depth"),
        )
        state = checkpointed(state.where("up is null").unionByName(moved))
    parents = links.where("up is not null").select(F.col("tree_id").alias("t"), F.col("up").alias("n")).distinct()
    leaves = state.join(parents, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")), "left_anti")
    ranked = Window.partitionBy("tree_id").orderBy(F.desc("score"), F.desc("depth"), "node_id")
    leaves = leaves.withColumn("rank", F.row_number().over(ranked))
    if per_tree is not None:
        leaves = leaves.where(F.col("rank") <= per_tree)
    paths = leaves.select(
        "tree_id", F.col("node_id").alias("leaf"), "rank", (F.col("depth") - 1).alias("place"), "node_id"
    )
    for k in reversed(range(len(jumps))):
        up = jumps[k].select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up")
        # A jump of 2**k reaches the posts that this bit of the distance leads to.
        further = paths.join(up, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")))
        further = further.where(F.col("place") >= 2**k)
        further = further.select("tree_id", "leaf", "rank", (F.col("place") - 2**k).alias("place"), F.col("up").alias("node_id"))
        paths = checkpointed(paths.union(further))  # else the plan would double with every jump
    return paths


def _escaped(column: str, signs: str):
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), rf"([{signs}])", r"\\$1")


def formatted(posts: DataFrame, per_tree: int | None = None) -> DataFrame:
    """One row per turn of the chosen paths: tree_id, leaf, rank, place, piece, and where in the piece the loss mask lies
    (characters, end exclusive; null where it does not)."""
    paths = best_paths(posts, per_tree)
    texts = posts.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "role", "text")
    rows = paths.join(texts, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")))
    role, text = _escaped("role", r"\\#<:"), _escaped("text", r"\\#<")
    rows = rows.select("tree_id", "leaf", "rank", "place", "role", role.alias("r"), text.alias("x"))
    start = F.when(F.col("role") == LEARNED, F.length("r") + len(HEAD) + len(MIDDLE))
    return rows.select(
        "tree_id",
        "leaf",
        "rank",
        "place",
        F.concat(F.lit(HEAD), "r", F.lit(MIDDLE), "x", F.lit(END)).alias("piece"),
        start.alias("loss_start"),
        (start + F.length("x")).alias("loss_end"),
    )


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class _Reader:
    """Takes a conversation's pieces in order and keeps digests, not texts."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        turn = _TURN.fullmatch(piece)
        if turn is None:
            raise ValueError("a piece is not one formatted turn")
        self.turns += 1
        self.chars += len(piece)
        self.all.update(f"{unescaped(turn[1])}\n{unescaped(turn[2])}\n".encode())
        if start is not None:
            learned = unescaped(piece[start:end])
            self.loss_chars += len(learned)
            self.learned.update(learned.encode())


_READ = "tree_id long, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _READ.split(", ")]
    types = [pa.string() if part.split()[1] == "string" else pa.int64() for part in _READ.split(", ")]
    key, reader = None, None

    def row() -> tuple:
        return (*key, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.learned.hexdigest(), reader.chars)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        rows = []
        for tree, leaf, piece, start, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if reader is None or (tree, leaf) != key:
                if reader is not None:
                    rows.append(row())
                key, reader = (tree, leaf), _Reader()
            reader.add(piece, start, end)
        yield made(rows)
    yield made([] if reader is None else [row()])


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted pieces alone."""
    python_path(pieces.sparkSession)
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.repartition(parts, "tree_id", "leaf").sortWithinPartitions("tree_id", "leaf", "place")
    return rows.select("tree_id", "leaf", "piece", "loss_start", "loss_end").mapInArrow(_read, _READ)


def as_posts(conversations: DataFrame) -> DataFrame:
    """A table of (conv_id, turn, role, text) as trees without branches: every row answers the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node_id"))
    parent = F.when(F.col("node_id") > 1, F.col("node_id") - 1)
    return rows.select(
        F.col("conv_id").cast("long").alias("tree_id"), "node_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score")
    )


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    found = read_back(formatted(as_posts(rows.union(own)), per_tree=1))
    return found.withColumnRenamed("tree_id", "conv_id").drop("leaf")


ORACLE_OP6 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v),
turns AS (
  SELECT *, length(regexp_replace(text, '[\\#<]', 'xx', 'g')) + length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + 15 AS size
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
