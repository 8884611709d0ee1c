"""Reply trees to training conversations: every root-to-leaf path, ranked branches, one formatted text each.

A message names its parent; iterative self-joins double the reach of every message's
jump to an ancestor, and each leaf then gathers its ancestors with the jumps, so a path of
n messages takes log2 n rounds and never more rows than the paths themselves have. A turn
is written as ``### role: text</turn>`` and a line end. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.base import col, saved
from landfall.plans.workspace import shared_dir

OPEN, NAMED, CLOSE = "### ", ": ", "</turn>\n"
#: What texts must not hold as it stands, and what is written for it; every backslash begins one of these.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
_ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
_FILE = "tree {kind}, branch long, branch_score double, formatted binary, loss array<struct<start:long,length:long>>"


def escaped(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    """``text`` without the control strings; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    """What escaped() was given: the written forms overlap nowhere, the backslash itself comes last."""
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _keyed(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    value = F.coalesce(col(messages, score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = messages.select(
        F.monotonically_increasing_id().alias("key"), col(messages, tree).alias("tree"), col(messages, node).alias("node"),
        col(messages, parent).alias("parent"), F.coalesce(col(messages, role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(messages, text), F.lit("")).alias("text"), value.alias("score"),
    )
    return saved(rows, "messages")


def _jumps(rows: DataFrame) -> list[DataFrame]:
    """(key, above) for jumps of 1, 2, 4, ... messages towards the root, until no message has so many above it.

    With more messages in a jump than there are, what is left runs in a circle: that table is the last one, else the last is empty.
    """
    ids = rows.filter("node IS NOT NULL").groupBy("tree", "node").agg(F.min("key").alias("above"))
    ids = ids.select(F.col("tree").alias("in_tree"), F.col("node").alias("id"), "above")
    replies = rows.filter("parent IS NOT NULL").select("key", "tree", "parent")
    first = replies.join(ids, F.col("tree").eqNullSafe(F.col("in_tree")) & (F.col("parent") == F.col("id"))).filter("key <> above")
    found, reach, total = [saved(first.select("key", "above"), "jumps")], 1, rows.count()
    while reach <= total and not found[-1].isEmpty():
        up = found[-1].select(F.col("key").alias("middle"), F.col("above").alias("top"))
        found.append(saved(found[-1].join(up, F.col("above") == F.col("middle")).select("key", F.col("top").alias("above")), "jumps"))
        reach *= 2
    return found


def paths(rows: DataFrame) -> DataFrame:
    """(leaf, key, depth) of keyed messages: each leaf with the messages on its path, depth 0 at the leaf itself.

    A leaf is a message without replies. Leaves whose ancestors run in a circle have no path.
    """
    *jumps, circles = _jumps(rows)
    replied = jumps[0] if jumps else circles
    leaves = rows.join(replied.select(F.col("above").alias("key")).distinct(), "key", "left_anti").join(circles.select("key"), "key", "left_anti")
    held = saved(leaves.select(F.col("key").alias("leaf"), "key", F.lit(0).cast("long").alias("depth")), "paths")
    for k, jump in enumerate(jumps):
        further = held.join(jump, "key").select("leaf", F.col("above").alias("key"), (F.col("depth") + (1 << k)).alias("depth"))
        held = held.unionByName(saved(further, "paths"))
    return held


def _numbered(branches: DataFrame) -> DataFrame:
    """``branches`` with ``branch``, the rank from 1 in its tree: higher score, then the leaf that comes first.

    A tree with very many branches is ranked by many tasks: by places in one range sort of all.
    """
    keys = [F.col("tree").asc_nulls_first(), F.col("branch_score").desc(), F.col("leaf")]
    ordered = branches.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = saved(ordered.withColumn("place", F.monotonically_increasing_id()), "branches")
    part = F.shiftright(F.col("place"), 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = ordered.join(F.broadcast(starts), part == F.col("part")).withColumn("at", F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    firsts = placed.groupBy(F.col("tree").alias("of_tree")).agg(F.min("at").alias("first"))
    ranked = placed.join(firsts, F.col("tree").eqNullSafe(F.col("of_tree")))
    return ranked.select("tree", "leaf", "branch_score", (F.col("at") - F.col("first") + 1).alias("branch"))


def write_conversations(
    messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text",
    score: str | None = None, branches: int | None = None, learned_role: str = "assistant", path: str | None = None,
) -> str:
    """Formats the ``branches`` best paths of every tree (all by default) as one conversation each; returns the folder.

    Columns written: tree, branch (rank from 1), branch_score (mean score of the path's messages),
    formatted (UTF-8), loss (start and length, in bytes of ``formatted``, of each text by
    ``learned_role``, in order). Ids are looked up within a tree. A message whose parent is null,
    unknown or itself is a root. Of messages with equal ids the replies belong to the first, and the
    others are leaves; a message without an id has no replies. Null scores count 0, null roles and
    texts are empty, a null tree is a tree like any other. Leaves above which there is a circle have
    no path. No messages, no rows.
    """
    rows = _keyed(messages, tree, node, parent, role, text, score)
    held = paths(rows)
    scored = held.join(rows.select("key", "tree", "score"), "key")
    best = _numbered(scored.groupBy("leaf").agg(F.first("tree").alias("tree"), F.avg("score").alias("branch_score")))
    if branches is not None:
        best = best.filter(F.col("branch") <= branches)
    best = saved(best, "ranked")

    named = F.concat(F.lit(OPEN), escaped(F.col("role"), _ROLE_ESCAPES), F.lit(NAMED))
    turns = rows.select("key", named.alias("named"), escaped(F.col("text")).alias("body"), (F.col("role") == learned_role).alias("learned"))
    turns = held.join(best, "leaf").join(turns, "key")
    size = F.octet_length("named") + F.octet_length("body") + len(CLOSE)
    path_order = Window.partitionBy("leaf").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)  # one conversation
    turns = turns.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(path_order), F.lit(0)) + F.octet_length("named"))
    turn = F.struct((-F.col("depth")).alias("at"), F.concat("named", "body", F.lit(CLOSE)).alias("turn"), "learned", "start", F.octet_length("body").cast("long").alias("length"))
    whole = turns.groupBy("leaf").agg(*[F.first(c).alias(c) for c in ("tree", "branch", "branch_score")], F.sort_array(F.collect_list(turn)).alias("turns"))
    learned = F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    path = path or shared_dir(messages.sparkSession, "conversations")
    whole.select("tree", "branch", "branch_score", F.array_join(F.col("turns.turn"), "").alias("formatted"), learned.alias("loss")).write.parquet(path)
    return path


def read_conversations(spark: SparkSession, path: str, tree_type: str = "long") -> DataFrame:
    """The files as tree, branch, branch_score, formatted (binary), loss, turns (role and text as they were) and learned (the texts under the mask)."""
    files = spark.read.schema(_FILE.format(kind=tree_type)).parquet(path)
    parts = F.split(F.col("formatted").cast("string"), CLOSE, -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        cut = F.locate(NAMED, part)
        name = F.substr(part, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        return F.struct(unescaped(name, _ROLE_ESCAPES).alias("role"), unescaped(F.substr(part, cut + len(NAMED))).alias("text"))

    under_mask = F.transform("loss", lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")))
    return files.withColumn("turns", F.transform(parts, turn)).withColumn("learned", under_mask)
