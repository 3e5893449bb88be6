"""I-Match fingerprints over a family of randomised lexicons.

The lexicon holds the terms whose document frequency, as a share of all
documents, lies in a band: common words say nothing about a text, and rare ones
are lost in any edit. A fingerprint hashes all sorted distinct terms of the band
that a text has, together, and the same again within each of a fixed family of
random lexicons: ``CHAINS`` chains of ``LEVELS`` lexicons, each a random half of
the one before it. A lexicon survives an edit of terms that it leaves out. The
large ones tell small edits of long texts from equal texts; the small ones, of
which a text has a term or none, still agree after large edits, in the share of
terms that the two texts have in common.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.llm.common import shuffle_partitions, store
from vialflow.llm.decontam import terms

#: Chains of random lexicons, and the lexicons in each: level j of a chain keeps one term of the band in 2**j.
CHAINS, LEVELS = 12, 15
_SHARED = 4
#: Terms of a lexicon that is sent to all tasks (8 bytes each, some 64 as a hash table); a larger one is joined by a shuffle.
BROADCAST_TERMS = 1 << 21
_NONE = ",".join("-" * CHAINS)


def distinct_terms(text: Column) -> Column:
    """Hashes of the distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.transform(terms(text), lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = 0.001, high: float = 0.1) -> DataFrame:
    """The term hashes (``term``) that occur in a share of ``low`` to ``high`` of the rows, written.

    All rows count. A text has d distinct terms in the mean, so no more than
    d / low terms can be in the band, however large the table.
    """
    seen = docs.select(F.explode(distinct_terms(F.col(text_col))).alias("term"))
    n = docs.count()
    counted = seen.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return store(counted.where((F.col("df") >= low * n) & (F.col("df") <= high * n)).select("term"), "imatch-lexicon")


def _words(term: Column) -> list[Column]:
    """Random numbers of 64 bits for a term, itself a hash; each deals ``_SHARED`` chains, by other bits."""
    return [term, *[_number(w)(term) for w in range(1, CHAINS // _SHARED)]]


def _number(w: int):
    return lambda term: F.xxhash64(F.lit(w), term)


def _mask(chain: int, bits: int) -> Column:
    return F.lit(bits << LEVELS * (chain % _SHARED)).cast("long")


def in_lexicon(term: Column, chain: int, level: int) -> Column:
    """Whether a term of the band is in the lexicon ``level`` of ``chain`` (from 0); level 0 is the whole band."""
    return _words(term)[chain // _SHARED].bitwiseAND(_mask(chain, (1 << level) - 1)) == 0


def _family(band: Column) -> Column:
    """For each level from 1, for each chain, the terms of ``band`` in that lexicon, in their order, each as the number that dealt it."""
    numbers = F.array(band, *[F.transform(band, _number(w)) for w in range(1, CHAINS // _SHARED)])
    whole = F.flatten(F.transform(numbers, lambda n: F.array_repeat(n, _SHARED)))
    masks = F.array(*[F.array(*[_mask(c, 1 << j) for c in range(CHAINS)]) for j in range(LEVELS)])

    def halved(levels: Column, bits: Column) -> Column:
        smaller = F.zip_with(F.element_at(levels, -1), bits, lambda kept, bit: F.filter(kept, lambda n: n.bitwiseAND(bit) == 0))
        return F.concat(levels, F.array(smaller))

    return F.slice(F.aggregate(masks, F.array(whole), halved), 2, LEVELS)


def _hex(digest: Column, digits: int) -> Column:
    return F.lower(F.right(F.lpad(F.hex(digest), 16, "0"), F.lit(digits)))


def rendered(band: Column, text_hash: Column) -> Column:
    """The fingerprint of a text with the sorted terms ``band``, as text.

    The hash of the whole band (16 hex digits), then for each level a slash and
    the hashes (8 digits) in its lexicons, "-" for a lexicon without a term;
    levels without any are left out. A text without a term of the band is a
    hash of itself.
    """
    entry = lambda kept: F.when(F.size(kept) > 0, _hex(F.xxhash64(kept), 8)).otherwise(F.lit("-"))
    levels = F.transform(_family(band), lambda level: F.array_join(F.transform(level, entry), ","))
    shown = F.concat_ws("/", _hex(F.xxhash64(band), 16), F.filter(levels, lambda e: e != _NONE))
    return F.when(F.size(band) > 0, shown).otherwise(F.concat(F.lit("--:"), _hex(text_hash, 16)))


def likeness(one: Column, two: Column) -> Column:
    """How alike two fingerprints are, 0 to 1, and 1 for equal ones.

    The share of equal hashes among the whole band, which differs in all but equal ones, and the lexicons with a term of either text, at
    the levels where at least one lexicon has no term of one of the texts: the
    larger lexicons hold so many terms of both that any larger edit changes all of them.
    Where there is no such level (over some 2**LEVELS terms), at all levels.
    """

    def levels(fingerprint: Column) -> Column:
        return F.slice(F.concat(F.slice(F.split(fingerprint, "/"), 2, LEVELS), F.array_repeat(F.lit(_NONE), LEVELS)), 1, LEVELS)

    def share(small: bool) -> Column:
        def level(x: Column, y: Column) -> Column:
            pairs = F.zip_with(F.split(x, ","), F.split(y, ","), lambda p, q: F.when((p != "-") | (q != "-"), (p == q).cast("int")))
            return F.when(F.contains(x, F.lit("-")) | F.contains(y, F.lit("-")), pairs) if small else pairs

        told = F.flatten(F.filter(F.zip_with(levels(one), levels(two), level), lambda v: v.isNotNull()))
        start = F.struct(F.lit(0).alias("equal"), F.lit(0).alias("all"))
        step = lambda s, e: F.struct((s["equal"] + F.coalesce(e, F.lit(0))).alias("equal"), (s["all"] + F.when(e.isNull(), 0).otherwise(1)).alias("all"))
        return F.aggregate(told, start, step, lambda s: F.when(s["all"] > 0, s["equal"] / (s["all"] + 1)))

    return F.when(one == two, F.lit(1.0)).otherwise(F.coalesce(share(True), share(False), F.lit(0.0)))


def _with_band(rows: DataFrame, keys: list[str], columns: list[str], known: DataFrame) -> DataFrame:
    """Put in place of each of ``columns``, arrays of distinct terms, its terms that are in the lexicon, sorted.

    ``keys`` name a row; the other columns go with one entry of each row only,
    not with every term. If the rows already lie together by one of the keys, no
    row moves, as long as the lexicon is counted and found small enough to go to all tasks; a larger
    one is joined by a shuffle of terms.
    """
    rest = [c for c in rows.columns if c not in keys and c not in columns]
    whole = F.struct(*[F.col(c) for c in rest])
    kind = rows.select(whole.alias("x")).schema["x"].dataType
    head = F.array(F.struct(F.lit(-1).alias("i"), F.xxhash64(*keys).alias("t"), whole.alias("row")))

    def tagged(i: int, c: str) -> Column:
        return F.transform(c, lambda t: F.struct(F.lit(i).alias("i"), t.alias("t"), F.lit(None).cast(kind).alias("row")))

    flat = rows.select(*keys, F.explode(F.concat(head, *[tagged(i, c) for i, c in enumerate(columns)])).alias("x"))
    flat = flat.select(*keys, F.col("x.i").alias("i"), F.col("x.t").alias("t"), F.col("x.row").alias("row"))
    known = F.broadcast(known) if known.count() <= BROADCAST_TERMS else known
    found = flat.join(known, (flat["t"] == known["term"]) & (flat["i"] >= 0), "left").where("i < 0 or term is not null")
    kept = [F.array_sort(F.collect_list(F.when(F.col("i") == i, F.col("t")))).alias(c) for i, c in enumerate(columns)]
    made = found.groupBy(*keys).agg(F.first("row", ignorenulls=True).alias("row"), *kept)
    return made.select(*keys, "row.*", *columns)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(doc_id, fingerprint) for every row. Null counts as an empty text; equal texts have equal fingerprints.

    No rows give none. Other columns are not read.
    """
    known = lexicon(docs, text_col) if known is None else known
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.xxhash64(F.lit(1), text).alias("a"), F.xxhash64(F.lit(2), text).alias("b"), text.alias("text"), F.col(id_col).alias("doc_id"))
    # one of each text is fingerprinted; the key stands for the text
    once = keyed.groupBy("a", "b").agg(F.any_value("text").alias("text"))
    once = once.select("a", "b", F.col("a").alias("h"), distinct_terms(F.col("text")).alias("s"))
    made = _with_band(once, ["a", "b"], ["s"], known)
    made = store(made.select(F.col("a").alias("ta"), F.col("b").alias("tb"), rendered(F.col("s"), F.col("h")).alias("fingerprint")), "imatch-made")
    return keyed.join(made, (keyed["a"] == made["ta"]) & (keyed["b"] == made["tb"])).select("doc_id", "fingerprint")


def _numbers(values: list[int]) -> Column:
    """An array of numbers as one literal, whatever their count."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bucketed(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` (id, text) with ``b``, the number of one of about ``n`` ranges of ids with as many rows each."""
    marks = docs.select(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    marks = sorted(set(marks))
    if not marks:
        return docs.withColumn("b", F.lit(0))
    # two short searches find the range: among every step-th mark, then between two of them
    step = math.isqrt(len(marks)) + 1
    big = F.size(F.filter(_numbers(marks[step - 1 :: step]), lambda m: m <= F.col("id"))) * step if len(marks) >= step else F.lit(0)
    small = F.size(F.filter(F.slice(_numbers(marks), big + 1, F.lit(step)), lambda m: m <= F.col("id")))
    return docs.withColumn("b", F.when(F.col("id").isNull(), len(marks)).otherwise(big + small))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Fingerprints of every text and of the same text with its last quarter replaced.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (:func:`likeness`). The replacement is the start of the next
    document's text, in ascending id (null ids last, ties by text; after the
    last the first). Texts move once, to ranges of ids; each range also gets the
    first row of the next one. Null counts as an empty text. Rows with equal ids
    or null ids lie in one range. No rows give none; other columns are not read.
    """
    known = lexicon(docs, text_col) if known is None else known
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = _bucketed(rows, 4 * shuffle_partitions(spark))
    # one row for each range, as many as the plan has marks: the first id of a range goes to the range before as well
    firsts = [tuple(r) for r in placed.groupBy("b").agg(F.min("id")).orderBy("b").collect()]
    before = [(i, firsts[k - 1][0]) for k, (_, i) in enumerate(firsts) if i is not None]
    placed = placed.withColumn("extra", F.lit(False))
    if before:
        target = F.broadcast(spark.createDataFrame(before, "first long, before int"))
        extra = rows.join(target, rows["id"] == target["first"]).select("id", "text", F.col("before").alias("b"), F.lit(True).alias("extra"))
        placed = placed.union(extra)
    order = Window.partitionBy("b").orderBy("extra", F.col("id").asc_nulls_last(), "text")
    near = placed.select("b", "extra", "id", "text", F.row_number().over(order).alias("r"), F.lead("text").over(order).alias("next"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.coalesce(F.expr("substring(next, 1, cast(floor(length(text) / 4) as int))"), F.lit("")))
    near = near.select("b", "r", "extra", "id", n.cast("long").alias("n_chars"), "text", F.when(cut > 0, edited).otherwise(F.col("text")).alias("edited"))
    hashes = [F.xxhash64(F.lit(1), "text").alias("h"), F.xxhash64(F.lit(1), "edited").alias("eh")]
    near = near.select("b", "r", "extra", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *hashes, distinct_terms(F.col("text")).alias("s"), distinct_terms(F.col("edited")).alias("e"))
    made = _with_band(near, ["b", "r"], ["s", "e"], known)
    made = made.select("b", "r", "extra", F.col("id").alias("doc_id"), "n_chars", "edited_sha256", rendered(F.col("s"), F.col("h")).alias("fingerprint"), rendered(F.col("e"), F.col("eh")).alias("edited_fingerprint"))
    made = made.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("b").orderBy("r"))).where(~F.col("extra"))
    out = [F.round(likeness(F.col("fingerprint"), F.coalesce(F.col(c), F.col("fingerprint"))), 6).alias(n) for c, n in (("edited_fingerprint", "near_edited"), ("next", "near_next"))]
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *out)
