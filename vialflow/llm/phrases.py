"""Phrase collocations by SON partitioning.

Rows are dealt to a few shards by a hash. Each shard is mined completely, level
by level, at its share of the support: a phrase that occurs ``support`` times
must occur ``ceil(support / shards)`` times in one shard at least. A phrase of
three words or more is looked at only where the two phrases one word shorter
were frequent. The union of what was frequent in some shard, less what the
shards' counts already rule out, is then counted over all rows, by its text.

Mining works on 64-bit hashes and passes its findings on as a bit filter of
fixed size. A clash of hashes or a full filter lets more phrases through to the
exact count; that changes the cost, never the result. Tasks count a few
megabytes of text before anything is shuffled, so a very common word or phrase
is one row for each such piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialflow.llm.common import batch_rows, shuffle_partitions, store

#: Fixed value: the bytes that end a piece, and those that part the words in it.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: Shards that are mined on their own, 256 at most. More shards lower the local support and so the power to rule phrases out.
SHARDS = 4
_SHARD_BITS = 8
#: Bytes of text that a task counts at once.
_CHUNK = 3 << 20
#: Rows of text that are handed to Python at once.
_BATCH = 500
#: The filter of phrases: segments, and bits of each; two bits are set for a phrase.
_SEGMENTS, _BITS = 64, 1 << 21
#: Places in a word that have numbers of their own, a power of two.
_PLACES = 64
_NUMBERS = np.random.PCG64(7).random_raw(_PLACES * 256)
_FOLD = bytes(10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _hashes(offsets: np.ndarray, body: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of a random number for each byte at its place."""
    if len(offsets) < 2:
        return np.zeros(0, np.uint64)
    place = np.arange(len(body)) - np.repeat(offsets[:-1], np.diff(offsets))
    numbers = _NUMBERS[((place & (_PLACES - 1)) << 8) | body]
    far = np.flatnonzero(place >= _PLACES)
    numbers[far] *= (2 * (place[far] // _PLACES) + 1).astype(np.uint64)
    return _mixed(np.add.reduceat(numbers, offsets[:-1]))


def _cut(text: bytes) -> Iterator[bytes]:
    """``text``, cut between pieces where it is longer than a chunk."""
    at = 0
    while len(text) - at > _CHUNK:
        ends = [e for e in (text.find(bytes([c]), at + _CHUNK) for c in ENDS) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:] if at else text


class _Chunk:
    """The words of some texts, and the hashes of the phrases that they make.

    With ``spelled`` each word also has a number of its own, ``codes``, in ``words``.
    """

    def __init__(self, texts: list[bytes], langs: list[str], shards: list[int], spelled: bool = False):
        self.langs = list(dict.fromkeys(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        data = np.frombuffer((b"\n".join(texts) + b"\n").translate(_FOLD), np.uint8)
        end = data == 10
        gap = (data == 32) | end
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        start, stop = edge[0::2], edge[1::2]
        start = start[: len(stop)]  # the last edge may be the end of the last word
        offsets = np.zeros(len(start) + 1, np.int64)
        np.cumsum(stop - start, out=offsets[1:])
        body = data[~gap]
        if spelled:
            words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
            coded = words.dictionary_encode()
            self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            self.words = coded.dictionary.to_pylist()
            ends = np.zeros(len(self.words) + 1, np.int64)
            np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)), out=ends[1:])
            self.hash = _hashes(ends, np.frombuffer(b"".join(self.words), np.uint8))[self.codes]
        else:
            self.hash = _hashes(offsets, body)
        self.piece = np.cumsum(end, dtype=np.int32)[start]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        counts = np.diff(np.searchsorted(start, ends), prepend=0)
        self.lang = np.repeat(np.array([number[x] for x in langs], np.int64), counts)
        self.shard = np.repeat(np.array(shards, np.uint8), counts)
        self.size = len(start)
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs] or [0], np.uint64)
        self.first = _mixed(self.hash + salt[self.lang])

    def levels(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words: where its phrases start, and the hashes (56 bits) of these and their language."""
        at, h = np.arange(self.size), self.first
        for n in range(1, longest + 1):
            if n > 1:
                whole = np.flatnonzero(at + n - 1 < self.size)
                whole = whole[self.piece[at[whole]] == self.piece[at[whole] + n - 1]]
                at, h = at[whole], h[whole]
                h = _mixed(h * np.uint64(0xD6E8FEB86659FD93) + self.hash[at + n - 1])
            yield n, at, h >> np.uint64(_SHARD_BITS)

    def phrases(self, at: np.ndarray, n: int) -> list[bytes]:
        """The texts of the phrases of ``n`` words that start there."""
        columns = [self.codes[at + i].tolist() for i in range(n)]
        return [b" ".join([self.words[c] for c in row]) for row in zip(*columns)] if n > 1 else [self.words[c] for c in columns[0]]


def _chunks(batches: Iterator[pa.RecordBatch], spelled: bool = False) -> Iterator[_Chunk]:
    texts, langs, shards, size = [], [], [], 0
    for batch in batches:
        for text, lang, shard in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for part in _cut(text.as_py()):
                texts.append(part)
                langs.append(lang)
                shards.append(shard)
                size += len(part) + 1
                if size >= _CHUNK:
                    yield _Chunk(texts, langs, shards, spelled)
                    texts, langs, shards, size = [], [], [], 0
    if texts:
        yield _Chunk(texts, langs, shards, spelled)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment and the two bits of each hash of 56 bits."""
    bits = np.uint64(_BITS - 1)
    return (h >> np.uint64(50)).astype(np.int64), (h & bits).astype(np.int64), ((h >> np.uint64(25)) & bits).astype(np.int64)


def _held(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    seg, one, two = _places(h)
    test = lambda b: bits[seg * (_BITS >> 3) + (b >> 3)] >> (b & 7).astype(np.uint8) & 1
    return (test(one) & test(two)).astype(bool)


def _filter(frequent: DataFrame) -> np.ndarray:
    """The bit filter of the hashes ``g``; ``_SEGMENTS`` parts of fixed size come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            seg, one, two = _places(batch.column(0).to_numpy().view(np.uint64))
            for s in np.unique(seg):
                bits = made.setdefault(int(s), np.zeros(_BITS >> 3, np.uint8))
                for b in (one[seg == s], two[seg == s]):
                    np.bitwise_or.at(bits, b >> 3, (1 << (b & 7)).astype(np.uint8))
        packed = [zstandard.compress(v.tobytes(), 1) for v in made.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array(packed, pa.binary())], names=["seg", "part"])

    parts = min(_SEGMENTS, shuffle_partitions(frequent.sparkSession))
    dealt = frequent.select("g", F.shiftrightunsigned("g", 50).alias("seg")).repartition(parts, "seg").select("g")
    out = np.zeros(_SEGMENTS * (_BITS >> 3), np.uint8)
    for seg, part in dealt.mapInArrow(run, "seg int, part binary").collect():
        out[seg * (_BITS >> 3) : (seg + 1) * (_BITS >> 3)] |= np.frombuffer(zstandard.decompress(part), np.uint8)
    return out


def _mined(rows: DataFrame, sizes: range, known: np.ndarray | None, support: int, shards: int) -> DataFrame:
    """Hashes ``g`` of the phrases with so many words that may reach ``support``; what is not in ``known`` was ruled out."""
    seen = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            found, shorter = [], None
            for n, at, h in chunk.levels(sizes[-1]):
                if seen is not None and n == sizes[0] - 1:
                    shorter = np.zeros(chunk.size + 1, bool)
                    shorter[at] = _held(seen.value, h)
                elif n in sizes:
                    keep = slice(None) if shorter is None else shorter[at] & shorter[at + 1]
                    found.append((h[keep] << np.uint64(_SHARD_BITS)) | chunk.shard[at[keep]].astype(np.uint64))
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["k", "c"])

    local = -(-support // shards)
    counted = rows.mapInArrow(count, "k long, c long").repartition(shuffle_partitions(rows.sparkSession), "k")
    mined = counted.groupBy("k").agg(F.sum("c").alias("c")).where(F.col("c") >= local)
    union = mined.groupBy(F.shiftrightunsigned("k", _SHARD_BITS).alias("g")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("in"))
    # a shard that did not report a phrase holds it local - 1 times at most
    return store(union.where(F.col("c") + (F.lit(shards) - F.col("in")) * (local - 1) >= support).select("g"), "phrases-mined")


def counts(docs: DataFrame, support: int = 10, longest: int = 3, shards: int = SHARDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to ``longest`` words with ``support`` occurrences or more in its language.

    Rows with ``words`` 0 and an empty phrase hold the number of all words of a language.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(text.alias("t"), lang.alias("l"), F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("s"))
    with batch_rows(docs.sparkSession, _BATCH):
        return _counted(rows, support, longest, shards)


def _counted(rows: DataFrame, support: int, longest: int, shards: int) -> DataFrame:
    known = _filter(_mined(rows, range(1, min(2, longest) + 1), None, support, shards))
    for n in range(3, longest + 1):
        known |= _filter(_mined(rows, range(n, n + 1), known, support, shards))
    seen = rows.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, spelled=True):
            total = np.bincount(chunk.lang, minlength=len(chunk.langs))
            lang, size, phrase, c = list(chunk.langs), [0] * len(total), [b""] * len(total), total.tolist()
            width, ids = len(chunk.words), None
            for n, at, h in chunk.levels(longest):
                # exact numbers of the phrases, made of those of the phrases one word shorter
                if ids is None:
                    ids = chunk.lang * width + chunk.codes
                else:
                    ids = pd.factorize(ids)[0][at] * width + chunk.codes[at + n - 1]
                keep = np.flatnonzero(_held(seen.value, h))
                _, first, often = np.unique(ids[keep], return_index=True, return_counts=True)
                where = at[keep[first]]
                lang += [chunk.langs[x] for x in chunk.lang[where].tolist()]
                size += [n] * len(where)
                phrase += chunk.phrases(where, n)
                c += often.tolist()
                if n < longest:
                    spread = np.zeros(chunk.size, np.int64)
                    spread[at] = ids
                    ids = spread
            for i in range(0, len(c), 20_000):
                cols = (x[i : i + 20_000] for x in (lang, size, phrase, c))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int32(), pa.binary(), pa.int64()))], names=["lang", "words", "phrase", "c"])

    found = rows.mapInArrow(count, "lang string, words int, phrase binary, c long")
    found = found.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f"))
    found = found.where((F.col("f") >= support) | (F.col("words") == 0))
    return store(found.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f"), "phrases-counts")


def collocations(docs: DataFrame, support: int = 10, longest: int = 3, top: int | None = 2000, absorbed: int = 50, shards: int = SHARDS) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language.

    Texts are lower-cased (A-Z), cut at ``ENDS`` and then at ``BLANKS``. A
    phrase that occurs a >= ``support`` times is scored by its worst cut into a
    first part (l times) and a rest (r times): floor(1000000 a a / (l r)), in
    whole numbers; of equal scores the cut after the fewest words counts. A
    phrase is left out if it lies inside a longer one that occurs at least
    ``absorbed`` percent as often. Returns (lang, rank, phrase, a, l, r, n,
    score), n the words of the language, ``top`` rows a language (None: all),
    by score and a falling, then by the bytes of the phrase.

    A null text is empty, a null language is ``und``; every row counts, also
    repeated ones; a language without such phrases has no rows, as has an
    empty table; other columns are not read. A text without any end of a piece
    is held in memory whole. Phrases and their parts are counted exactly.
    """
    every = counts(docs, support, longest, shards)
    phrases = every.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns({"x": F.expr("substring_index(phrase, ' ', k)"), "y": F.expr("substring_index(phrase, ' ', k - words)")})
    part = every.where("words >= 1")
    cut = cut.join(part.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l")), ["lang", "x"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r")), ["lang", "y"])
    score = F.expr("(cast(1000000 as decimal(7, 0)) * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.any_value("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("worst"))

    inner = phrases.where("words >= 3").withColumn("w", F.split("phrase", " "))
    inner = inner.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), F.col("a").alias("around"))
    around = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * absorbed))

    order = Window.partitionBy("lang").orderBy(F.col("worst.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    total = every.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
