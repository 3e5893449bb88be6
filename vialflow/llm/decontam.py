"""Benchmark decontamination by size-partitioned containment search.

A document is contaminated by a test item if it holds at least ``threshold`` of
the item's distinct five-word shingles. Items are partitioned by size. Each
item's MinHash sketch is its k smallest shingle hashes, k being one more than
the number of shingles that an item of the largest size in its partition may
miss; so a document that reaches the threshold holds one of them for certain.
The sketches are looked up among all shingles of every long document, and what
they find is verified with the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.llm.common import store

#: Fixed value: a word is a run of letters and digits, in lower case.
TERM = r"[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TERM})"), F.lit(1))


def _grams(words: Column, length: int, make) -> Column:
    """``make`` of each run of ``length`` words; an empty array if there are fewer."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda i: make(*[F.get(words, i + j) for j in range(length)]))
    return F.when(F.size(words) >= length, runs)


def _joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def _items(benchmark: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float) -> DataFrame:
    """(item, size, need, wide, grams, sketch): wide is the words in a shingle, need the least shared."""
    w = benchmark.select(F.col(id_col).alias("item"), terms(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    made = F.lit(None).cast("array<string>")
    for n in range(1, shingle + 1):
        made = F.when(F.least(F.size("w"), F.lit(shingle)) == n, _grams(F.col("w"), n, _joined)).otherwise(made)
    w = w.select("item", F.least(F.size("w"), F.lit(shingle)).alias("wide"), F.array_distinct(made).alias("grams"))
    w = w.withColumn("size", F.size("grams")).withColumn("need", F.ceil(F.col("size") * F.lit(threshold) - 1e-9).cast("int"))
    # the partition of sizes 2**j to 2**(j+1) - 1 shares the k of its largest size
    largest = F.pow(F.lit(2), F.floor(F.log2("size")) + 1) - 1
    k = (largest - F.ceil(largest * threshold - 1e-9) + 1).cast("int")
    hashes = F.array_sort(F.transform("grams", lambda g: F.xxhash64(g)))
    return w.withColumn("sketch", F.slice(hashes, F.lit(1), F.least(k, F.col("size"))))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment), one row for each pair that reaches the threshold.

    Words are runs of letters and digits in lower case. An item of fewer words
    than ``shingle`` is one shingle of all its words; an item without words
    (null or empty) matches nothing, nor does a document without words. Rows
    that share an id are texts of their own, and the best of them is reported.
    Null ids are reported as null. Other columns are not read.
    """
    items = store(_items(benchmark, item_id_col, item_text_col, shingle, threshold), "decontam-items")
    widths = sorted(r[0] for r in items.select("wide").distinct().collect())  # ``shingle`` values at most
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    if not widths:
        types = {"doc": dict(texts.dtypes)["doc"], "item": dict(items.dtypes)["item"]}
        return docs.sparkSession.createDataFrame([], f"doc_id {types['doc']}, item_id {types['item']}, item_shingles int, shared int, containment double")
    sketch = store(items.select("item", "wide", "need", F.explode("sketch").alias("key")), "decontam-sketch")
    words = texts.select("doc", terms(F.col("text")).alias("w"))
    hits = []
    for wide in widths:
        hashes = _grams(F.col("w"), wide, lambda *p: F.xxhash64(_joined(*p)))
        looked = words.select("doc", F.size("w").alias("n"), F.explode(hashes).alias("hash"))
        own = sketch.where(F.col("wide") == wide).drop("wide")
        enough = looked["n"] - F.lit(wide - 1) >= own["need"]
        hits.append(looked.join(own, (looked["hash"] == own["key"]) & enough).select("doc", "item", F.lit(wide).alias("wide")))
    candidates = store(_union(hits).distinct(), "decontam-candidates")

    verified = []
    for wide in widths:
        pairs = candidates.where(F.col("wide") == wide).select(F.col("doc").alias("d"), F.col("item").alias("i"))
        own = items.select(F.col("item"), "size", F.col("grams").alias("wanted"))
        some = pairs.select(F.col("d").alias("s")).distinct()
        grams = F.array_distinct(_grams(F.col("w"), wide, _joined))
        found = texts.join(some, texts["doc"].eqNullSafe(some["s"]), "left_semi")
        found = found.select("doc", terms(F.col("text")).alias("w")).select("doc", grams.alias("grams"))
        found = found.join(pairs, found["doc"].eqNullSafe(pairs["d"]))
        found = found.join(own, found["i"].eqNullSafe(own["item"]))
        shared = F.size(F.array_intersect("wanted", F.coalesce("grams", F.array().cast("array<string>"))))
        verified.append(found.select(F.col("doc").alias("doc_id"), F.col("i").alias("item_id"), F.col("size").alias("item_shingles"), shared.alias("shared")))
    exact = _union(verified).withColumn("containment", F.col("shared") / F.col("item_shingles")).where(F.col("shared") >= F.col("item_shingles") * F.lit(threshold) - 1e-9)
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "shared", "item_shingles")).alias("m"))
    return best.select("doc_id", "item_id", "m.item_shingles", "m.shared", "m.containment")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose text is contaminated; columns as they came.

    A text is judged by its words alone, so rows with null or shared ids are
    kept or dropped for their own text.
    """
    key = F.concat_ws("-", *[F.xxhash64(F.lit(s), docs[text_col]).cast("string") for s in (1, 2)])
    found = contaminated(docs.select(key.alias("doc"), docs[text_col].alias("text")), benchmark, "doc", "text", **how)
    gone = store(found.select(F.col("doc_id").alias("__gone")).distinct(), "decontam-gone")
    return docs.join(gone, key == gone["__gone"], "left_anti")
