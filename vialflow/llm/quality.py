"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees are grown on statistics of labelled texts; each path from a root
is a rule, a conjunction of thresholds. A logistic model with a lasso penalty
weighs the rules and drops most. What is left is compiled into one Spark column
expression, so scoring is a projection.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.llm.common import store

#: Labelled rows that a model is fitted on at most: those with the smallest hashed id.
TRAIN_ROWS = 20_000
Rule = tuple[tuple[int, str, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text; a null text counts as empty, and an empty one has zeros."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.split(t, r"[\x20\x09-\x0D]+")
    n_words = F.size(words).cast("double")
    lines = F.split(t, "\n")
    per = lambda pattern, of: F.regexp_count(t, F.lit(pattern)) / of
    return {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "chars_per_word": F.length(t) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "upper": per(r"\p{Lu}", n),
        "symbols": per(r"[^\p{L}\p{N}\s.,;:'\"?!()-]", n),
        "doubled_marks": per(r"[!?]{2}", n_words),
        "digits": per(r"\p{N}", n),
        "stops": per(r"\.", n_words),
        "chars_per_line": F.length(t) / F.size(lines),
        "repeated_lines": F.lit(1.0) - F.size(F.array_distinct(lines)) / F.size(lines),
    }


NAMES = tuple(f"stat_{i}" for i in range(10))


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, stat_0 ...): each statistic is made once for each row."""
    made = statistics(F.col(text_col)).values()
    return docs.select(F.col(id_col).alias("id"), *[c.cast("double").alias(n) for c, n in zip(made, NAMES)])


def paths(tree: str) -> list[Rule]:
    """The conjunctions on the way to every node below the root of a tree's debug text."""
    out, way = [], []
    for line in tree.splitlines():
        found = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            depth, test = len(found[1]), (int(found[2]), found[3], float(found[4]))
            way = [(d, t) for d, t in way if d < depth] + [(depth, test)]
            out.append(tuple(t for _, t in way))
    return out


def rule(tests: Rule) -> Column:
    """The rule as a column: 1 where all tests hold."""
    held = F.lit(True)
    for i, sign, at in tests:
        held = held & (F.col(NAMES[i]) <= at if sign == "<=" else F.col(NAMES[i]) > at)
    return F.when(held, 1.0).otherwise(0.0)


class Model:
    """Rules with weights; ``score`` is a column over the columns of :func:`measured`."""

    def __init__(self, rules: list[tuple[Rule, float]], bias: float) -> None:
        self.rules, self.bias = rules, bias

    def score(self) -> Column:
        total = F.lit(self.bias)
        for tests, weight in self.rules:
            total = total + rule(tests) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rounds: int = 12, depth: int = 3, lasso: float = 0.002) -> Model:
    """Fit on the labelled rows of ``docs``, ``TRAIN_ROWS`` of them at most.

    Rows without a label, id or document do not count; of repeated labels of an
    id, the smallest holds, and of its documents the text with the least hash.
    Other columns of ``docs`` are not read, whatever their names. If one class only is left, every text scores that
    class's share, smoothed; without any label, 0.5.
    """
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("lid")).agg(F.min(label_col).cast("double").alias("y"))
    y = store(y.orderBy(F.xxhash64("lid"), "lid").limit(TRAIN_ROWS), "quality-labels")
    some = docs.join(F.broadcast(y), docs[id_col] == y["lid"])
    stats = [c.cast("double").alias(n) for c, n in zip(statistics(docs[text_col]).values(), NAMES)]
    one = some.select(y["lid"].alias("lid"), F.xxhash64(docs[text_col]).alias("h"), F.struct(y["y"].alias("y"), *stats).alias("row"))
    rows = store(one.groupBy("lid").agg(F.min_by("row", "h").alias("row")).select("row.*"), "quality-train").coalesce(4).cache()
    try:
        share = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        n, ones = sum(share.values()), share.get(1.0, 0)
        if not 0 < ones < n:
            odds = (ones + 0.5) / (n - ones + 0.5)
            return Model([], math.log(odds))
        grown = GBTClassifier(labelCol="y", featuresCol="x", maxIter=rounds, maxDepth=depth, maxBins=64, minInstancesPerNode=max(5, n // 1000), stepSize=0.3, seed=7).fit(rows.select("y", array_to_vector(F.array(*NAMES)).alias("x")))
        found = list(dict.fromkeys(p for t in grown.trees for p in paths(t.toDebugString)))
        if not found:
            return Model([], math.log(ones / (n - ones)))
        held = rows.select("y", array_to_vector(F.array(*map(rule, found))).alias("x")).cache()
        fitted = LogisticRegression(labelCol="y", featuresCol="x", regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60).fit(held)
        held.unpersist()
    finally:
        rows.unpersist()
    weights = fitted.coefficients.toArray()
    return Model([(r, float(w)) for r, w in zip(found, weights) if w], float(fitted.intercept))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for every row; null and empty texts are scored by their zeros."""
    rows = measured(docs, id_col, text_col).select(F.col("id").alias("doc_id"), model.score().alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; columns as they came."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(row, *[c.cast("double").alias(n) for c, n in zip(statistics(docs[text_col]).values(), NAMES)])
    # a filter would be pushed below the statistics and make them anew for each rule; a generator stays above
    kept = F.when(model.score() >= threshold, F.array("row"))
    return rows.select(F.explode(kept).alias("row")).select("row.*")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; these rows are kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


