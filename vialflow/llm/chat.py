"""Collapse of logged conversation snapshots, and rendering of what is left.

A chat log often has a conversation once for each turn, each time longer. A
rolling hash of the turns identifies every prefix of every conversation; a
conversation whose whole hash is the hash of a proper prefix of another is a
snapshot of that one and goes. Of equal conversations the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.llm.common import store

#: Turns of a conversation that are numbered and hashed together; a longer one is many such pieces.
PIECE = 256


def prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, piece, k, a, b): of every turn its number k in the conversation, from 1, and the hash of the first k turns.

    A turn's hash has its number, role and text, each told from null; a prefix's
    is the exclusive-or of its turns' hashes, in 128 bits. Sums run within
    pieces of a conversation first and then over its pieces, so a very long
    conversation is dealt to many tasks.
    """
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    mark = F.struct(F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    # repeated rows and ties of a turn number are ordered by content, so that equal logs have equal hashes
    t = t.select("conv", "turn", F.floor(F.coalesce("turn", F.lit(-1)) / PIECE).alias("piece"), F.xxhash64(F.lit(1), mark).alias("a"), F.xxhash64(F.lit(2), mark).alias("b"))
    t = store(t, "chat-turns")
    per = t.groupBy("conv", "piece").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    per = store(per.select("conv", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0")), "chat-pieces")
    here = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    numbered = _join(t.withColumn("i", F.row_number().over(here)), per, ["n0"])
    numbered = numbered.withColumn("k", F.col("n0") + F.col("i"))
    own = [F.xxhash64(F.lit(s), "k", c).alias(c) for s, c in ((3, "a"), (4, "b"))]
    hashed = store(numbered.select("conv", "piece", "k", *own), "chat-hashed")
    whole = hashed.groupBy("conv", "piece").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    zero = F.lit(0).cast("long")
    whole = store(whole.select("conv", "piece", *[F.coalesce(F.bit_xor(c).over(earlier), zero).alias(f"{c}0") for c in "ab"]), "chat-sums")
    running = Window.partitionBy("conv", "piece").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select("conv", "piece", "k", *[F.bit_xor(c).over(running).alias(c) for c in "ab"])
    rolled = _join(rolled, whole, ["a0", "b0"])
    return rolled.select("conv", "piece", "k", *[F.col(c).bitwiseXOR(F.col(f"{c}0")).alias(c) for c in "ab"])


def _join(left: DataFrame, right: DataFrame, add: list[str]) -> DataFrame:
    r = right.select(F.col("conv").alias("rc"), F.col("piece").alias("rp"), *add)
    return left.join(r, left["conv"].eqNullSafe(r["rc"]) & (left["piece"] == r["rp"])).drop("rc", "rp")


def maximal(turns: DataFrame, **cols: str) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of another; of equal ones the smallest id.

    Turns are ordered by number (null first), ties by content; gaps in the
    numbers do not count. Rows with a null id are one conversation. Repeated
    rows are turns of their own. A null role or text is told from an empty one.
    """
    rolled = store(prefixes(turns, **cols), "chat-prefixes")
    n = store(rolled.groupBy("conv").agg(F.max("k").alias("n")), "chat-lengths")
    ends = rolled.join(n.select(F.col("conv").alias("nc"), "n"), F.col("conv").eqNullSafe(F.col("nc")))
    ends = store(ends.select("conv", "k", "a", "b", (F.col("k") == F.col("n")).alias("whole")), "chat-ends")
    # both sides hold each hash once, however many conversations share it
    last = ends.where("whole").groupBy("k", "a", "b").agg(F.min("conv").alias("conv_id"))
    inner = ends.where(~F.col("whole")).select(F.col("k").alias("ik"), F.col("a").alias("ia"), F.col("b").alias("ib")).distinct()
    left = last.join(inner, (F.col("k") == F.col("ik")) & (F.col("a") == F.col("ia")) & (F.col("b") == F.col("ib")), "left_anti")
    return left.select("conv_id", F.col("k").alias("n_turns"))


def template(role: Column, text: Column) -> Column:
    """A turn as ``<|role|>``, a line end, the text and a line end.

    No text or role can pass for the marker of another turn: in a text ``<|``
    becomes ``<\\|`` and ``<\\`` becomes ``<\\\\``, in a role every ``|`` and ``\\``
    gets a backslash. Taking these backslashes away gives the log's text back.
    """
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"<([|\\])", r"<\\$1")
    role = F.regexp_replace(F.coalesce(role, F.lit("")), r"([|\\])", r"\\$1")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def rendered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, segment): the rendered turns of the maximal conversations, one row each.

    Other columns are not read; an empty table has an empty result.
    """
    kept = store(maximal(turns, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col).select(F.col("conv_id").alias("kept")), "chat-kept")
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), template(F.col(role_col), F.col(text_col)).alias("segment"))
    return t.join(kept, t["conv_id"].eqNullSafe(kept["kept"]), "left_semi")
