"""Mixing sources to target weights by pivotal dependent rounding.

Each row of a source should be taken r times, r being the target of its
source over the source's size. The whole part of r is taken outright; the
fractional parts are rounded together. Two open rows trade mass (probability
times size) at random until one probability becomes zero or one, which keeps
both the expected copies of each row and the exact mass of the pair. Blocks of
rows are reduced this way to one open row each, blocks of blocks likewise, up a
tree, so a source's taken mass differs from its target by the last open row
at most. Rounding never adds more than one copy to the whole part, and r is at
most two, so no row is taken more than twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.llm.common import store, words

#: Rows (or open rows of the level below) that one node of the tree rounds.
BLOCK = 64


def targets(sizes: Sequence[float], weights: Sequence[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight; none over ``most`` times its size, the excess reshared by weight."""
    out, free = [0.0] * len(sizes), [i for i in range(len(sizes)) if weights[i] > 0]
    left = float(total)
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / whole >= most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / whole
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def _uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


_KEY = "struct<a:long,b:long,k:int>"


def _round_block(rows: Column, seed: int) -> Column:
    """Fold one block: struct(done: array of (key, up), open: the row left, or null).

    ``rows`` is an array of (u, key, w, p) with 0 < p < 1 and w > 0.
    """
    none = F.lit(None).cast(f"struct<u:double,key:{_KEY},w:double,p:double>")
    start = F.struct(F.array().cast(f"array<struct<key:{_KEY},up:boolean>>").alias("done"), none.alias("open"))

    def row(x: Column, p: Column) -> Column:
        return F.struct(x["u"].alias("u"), x["key"].alias("key"), x["w"].alias("w"), p.alias("p"))

    def step(state: Column, b: Column) -> Column:
        a = state["open"]
        up_a, down_b = (F.lit(1.0) - a["p"]) * a["w"], b["p"] * b["w"]
        down_a, up_b = a["p"] * a["w"], (F.lit(1.0) - b["p"]) * b["w"]
        first, second = F.least(up_a, down_b), F.least(down_a, up_b)
        raise_a = _uniform(F.lit(seed), a["key"], b["key"]) * (first + second) < second
        # which of the two reaches its end; the other stays open, at its end itself if both do
        a_ends = F.when(raise_a, up_a <= down_b).otherwise(down_a <= up_b)
        move = F.when(raise_a, first).otherwise(-second)
        left = F.when(a_ends, b["p"] - move / b["w"]).otherwise(a["p"] + move / a["w"])
        left = F.least(F.greatest(left, F.lit(0.0)), F.lit(1.0))
        ended = F.struct(F.when(a_ends, a["key"]).otherwise(b["key"]).alias("key"), F.when(a_ends, raise_a).otherwise(~raise_a).alias("up"))
        traded = F.struct(F.concat(state["done"], F.array(ended)).alias("done"), F.when(a_ends, row(b, left)).otherwise(row(a, left)).alias("open"))
        return F.when(a.isNull(), F.struct(state["done"].alias("done"), row(b, b["p"]).alias("open"))).otherwise(traded)

    return F.aggregate(rows, start, step)


def pivotal(rows: DataFrame, counts: dict[int, int], seed: int = 7) -> DataFrame:
    """Round (src int, key struct(a, b, k), w double, p double), 0 < p < 1 and w > 0, to (key, up boolean).

    ``counts`` holds the rows of each src and sets the number of blocks of each
    tree. A block gathers ``BLOCK`` rows of one source in the mean, so a source
    with a third of all rows is many blocks in many tasks.
    """
    blocks = {s: max(1, -(-n // BLOCK)) for s, n in counts.items()} or {0: 1}
    level, done, depth = rows, [], 0
    while True:
        table = F.create_map(*[x for s, b in blocks.items() for x in (F.lit(s), F.lit(b).cast("long"))])
        keyed = level.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit(depth), "key"), F.element_at(table, F.col("src"))))
        packed = F.struct(_uniform(F.lit(seed + 1), F.col("key")).alias("u"), F.col("key"), F.col("w"), F.col("p"))
        folded = keyed.groupBy("src", "block").agg(F.sort_array(F.collect_list(packed)).alias("rows"))
        folded = store(folded.select("src", _round_block(F.col("rows"), seed + 2).alias("s")), f"mix-level{depth}")
        done.append(folded.select(F.explode("s.done").alias("d")).select("d.key", "d.up"))
        level = folded.where(F.col("s.open").isNotNull()).select("src", "s.open.key", "s.open.w", "s.open.p")
        if all(b == 1 for b in blocks.values()):
            break
        blocks, depth = {s: max(1, -(-b // BLOCK)) for s, b in blocks.items()}, depth + 1
    out = level.select("key", (_uniform(F.lit(seed + 3), F.col("key")) < F.col("p")).alias("up"))
    for d in done:
        out = out.union(d)
    return out


def plan_mix(rows: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """``rows`` (a, b, k: a unique key; source string, size long; others) with source_size, target and copies.

    Sources in code-point order, null last, take the weights in turn; together
    they get ``share`` of all sizes. One row for each source comes to the
    driver: weights are given by source, so the list of sources is part of the
    request.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("n")).collect()
    per.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [float(r["size"]) for r in per]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], share * sum(sizes), most)
    listed, counts = [], {}
    for i, r in enumerate(per):
        ratio = goal[i] / sizes[i] if sizes[i] else 0.0
        listed.append((i, r["source"], int(r["size"]), goal[i], int(ratio), ratio - int(ratio)))
        if ratio > int(ratio) and r["n"]:
            counts[i] = r["n"]
    dim = rows.sparkSession.createDataFrame(listed, "src int, s string, source_size long, target double, whole int, p double")
    known = rows.join(F.broadcast(dim), rows["source"].eqNullSafe(dim["s"]))
    key = F.struct(F.col("a"), F.col("b"), F.col("k")).alias("key")
    open_ = known.where("p > 0 and size > 0").select("src", key, F.col("size").cast("double").alias("w"), "p")
    ups = store(pivotal(open_, counts, seed).where("up").select(*[F.col("key")[c].alias(f"up_{c}") for c in "abk"]), "mix-up")
    same = [known[c] == ups[f"up_{c}"] for c in "abk"]
    copies = F.col("whole") + F.when(F.col("up_k").isNotNull(), 1).otherwise(0)
    return known.join(ups, same, "left").select(*rows.columns, "source_size", "target", copies.cast("int").alias("copies"))


def _row_key(*cols: Column) -> list[Column]:
    """128 bits of a row's content: the same wherever and however often the row is read."""
    return [F.xxhash64(F.lit(s), *cols).alias(n) for s, n in ((1, "a"), (2, "b"))]


def _numbered(keyed: DataFrame, *carry: str) -> DataFrame:
    """Rows with equal keys are repeated rows: count them, and number them 1 to n."""
    same = keyed.groupBy("a", "b", "source", "size", *carry).agg(F.count(F.lit(1)).cast("int").alias("n"))
    return same.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    A null text has size 0; a source whose rows are all empty has target 0; rows
    of size 0 are taken as often as the whole part of their source's ratio.
    A null source is a source of its own, the last one. Repeated rows are rows
    of their own. Draws depend on the rows' content alone, so reruns agree on
    any cluster. Other columns are not read.
    """
    i, t, s = F.col(id_col), F.col(text_col), F.col(source_col)
    keyed = docs.select(*_row_key(i, s, t), i.alias("doc_id"), s.alias("source"), word_count(t).alias("size"))
    rows = store(_numbered(keyed, "doc_id"), "mix-rows")
    return plan_mix(rows, **how).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (not at all to twice); columns as they came."""
    i, t, s = F.col(id_col), F.col(text_col), F.col(source_col)
    rows = store(_numbered(docs.select(*_row_key(i, s, t), s.alias("source"), word_count(t).alias("size"))), "mix-rows")
    plan = plan_mix(rows, **how).groupBy("a", "b").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("n"))
    plan = store(plan.where("c > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), "c", "n"), "mix-copies")
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_row_key(i, s, t))
    met = own.join(plan, (own["a"] == plan["pa"]) & (own["b"] == plan["pb"]))
    # of n equal rows, the k-th takes its even share of their copies
    k = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.lit(1)))
    copies = F.floor(F.col("c") * k / F.col("n")) - F.floor(F.col("c") * (k - 1) / F.col("n"))
    taken = met.select("row", copies.cast("int").alias("copies")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
