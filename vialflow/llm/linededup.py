"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, rarest first, from
counts over all documents; two sets with a Jaccard similarity of t or more then
share a word in their prefixes of size - ceil(t * size) + 1 words. Each prefix
word is a posting. Postings of a word meet in one place, in blocks, where
length, position and a bitmap of the words, wider for longer lines, bound the
overlap of two lines; pairs that may reach t are verified with their words. A
line with a match that is earlier in (document, line) order is removed.

Only the first line of each set takes part; of its copies, a task removes those
that it has seen an earlier one of, and the rest go where the lines of a set
meet. A posting asks for the ``NEAREST`` earlier lines that may match; if none
of them verifies and there are more, it asks for all of the rest in a second
round, from the postings of its word that the first round set aside. So a group
of alike lines makes about as many pairs as it has lines, and no match is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import WORD, shuffle_partitions, small_batches, store

#: Buckets of the word counts, a power of two. Words share buckets; that changes the order of words, not the result.
BUCKETS = 1 << 22
_SEGMENTS = 64
#: Possible matches that a posting asks for in the first round.
NEAREST = 2
#: A word that occurs more often is dealt to a group for each so many occurrences, 64 at most; each group gets all who ask.
SPLIT = 1 << 16
#: Bytes of text that are taken apart at once, and bytes whose words are hashed at once.
_SLICE, _PIECE = 1 << 20, 1 << 18
#: Bits, a power of two, of the filter of lines to read again. A full filter lets more lines through; that changes the cost, not the result.
_FILTER = 1 << 27
#: A place is (id, rank of the text among those of its id, line): rank and line share a long. The id of rows that have none.
_NO_BITS, _NO_ID = 31, (1 << 63) - 1
#: A rank is a number within a range of hashes; so many ranges, so that a hot id is numbered in many tasks.
_RANGE_BITS = 12
#: Fixed value: ASCII white space.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random number for each byte at each place in a word, the places taken modulo ``_PLACES``.
_PLACES = 64
_CODES = np.random.PCG64(42).random_raw(_PLACES * 256)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Ids (with a third column, ranks beside them) and texts of a batch, about ``_SLICE`` bytes of text at a time."""
    ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).cast(pa.large_binary()).fill_null(b"")
    if batch.num_columns > 2:
        ids = np.column_stack([ids, batch.column(2).to_numpy(zero_copy_only=False)])
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ids):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE, "right")))
        yield ids[at:stop], texts.slice(at, stop - at)
        at = stop


def _next_break(data: np.ndarray, at: int, end: int) -> int:
    """The first white space from ``at`` on, or ``end``."""
    while at < end:
        found = np.flatnonzero(_SPACE[data[at : min(at + 4096, end)]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return end


def _hashes(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``part`` start, and their hashes: the sum of a random number for each byte at its place.

    A word ends at white space and at ``bounds``, where texts meet.
    """
    space, apart = _SPACE[part], np.zeros(len(part), bool)
    apart[bounds] = True
    new = ~space
    new[1:] &= space[:-1] | apart[1:]
    starts = np.flatnonzero(new)
    if not len(starts):
        return starts, np.zeros(0, np.int64)
    body, space = part[starts[0] :], space[starts[0] :]
    place = np.arange(starts[0], len(part)) - np.repeat(starts, np.diff(starts, append=len(part)))
    codes = _CODES[(place % _PLACES) * 256 + body]
    far = np.flatnonzero(place >= _PLACES)
    codes[far] *= (2 * (place[far] // _PLACES) + 1).astype(np.uint64)
    codes[space] = 0
    return starts, (np.add.reduceat(codes, starts - starts[0]) >> np.uint64(1)).astype(np.int64)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hash and the line of every word, and for every line with words its text and its number there."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at, end = int(offsets[0]), int(offsets[-1])
    starts, hashes, feeds = [], [], []
    while at < end:
        stop = min(at + _PIECE, end)
        stop = _next_break(data, stop, int(offsets[np.searchsorted(offsets, stop)]))
        part = data[at:stop]
        inside = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop)] - at
        where, h = _hashes(part, inside)
        starts.append(where + at)
        hashes.append(h)
        feeds.append(np.flatnonzero(part == 10) + at)
        at = stop
    start, h, feed = (np.concatenate(parts or [np.zeros(0, np.int64)]) for parts in (starts, hashes, feeds))
    text = np.searchsorted(offsets, start, "right") - 1
    before = np.searchsorted(feed, start)
    first = np.ones(len(start), bool)
    first[1:] = (text[1:] != text[:-1]) | (before[1:] != before[:-1])
    heads = np.flatnonzero(first)
    no = before[heads] - np.searchsorted(feed, offsets[:-1])[text[heads]]
    return h, np.cumsum(first) - 1, text[heads], no


def _gathered(spark: SparkSession, sent: DataFrame, dtype: str, add, finish, width: int) -> np.ndarray:
    """Pieces (seg, part) of arrays, packed, put together with ``add`` in tasks; ``_SEGMENTS`` x ``width`` bytes come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for seg, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                piece = np.frombuffer(unpacker.decompress(part.as_py()), dtype)
                total[seg] = add(total[seg], piece) if seg in total else piece
        packer = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([packer.compress(finish(v).tobytes()) for v in total.values()], pa.binary())], names=["seg", "part"])

    whole = sent.repartition(min(_SEGMENTS, shuffle_partitions(spark)), "seg").mapInArrow(run, "seg int, part binary")
    out = np.zeros((_SEGMENTS, width), np.uint8)
    for r in whole.collect():
        out[r["seg"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["part"])), np.uint8)
    return out.reshape(-1)


def _sent(held: np.ndarray) -> pa.RecordBatch:
    packer = zstandard.ZstdCompressor(level=1)
    parts = [packer.compress(p.tobytes()) for p in held.reshape(_SEGMENTS, -1)]
    return pa.RecordBatch.from_arrays([pa.array(range(_SEGMENTS), pa.int32()), pa.array(parts, pa.binary())], names=["seg", "part"])


def _marks(frame: DataFrame, bits: int, probes) -> np.ndarray:
    """A bit set, as bytes, of the numbers that ``probes`` makes of the columns of ``frame``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in probes(*(c.to_numpy() for c in batch.columns)):
                np.bitwise_or.at(held, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield _sent(held)

    return _gathered(frame.sparkSession, frame.mapInArrow(run, "seg int, part binary"), "u1", np.bitwise_or, lambda v: v, bits // 8 // _SEGMENTS)


def _marked(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _place_bits(doc: np.ndarray, no: np.ndarray) -> list[np.ndarray]:
    """Two bits of the filter for each line."""
    key = _mix(_mix(doc, 4) + no.astype(np.uint64), 5)
    return [((key >> np.uint64(s)) & np.uint64(_FILTER - 1)).astype(np.int64) for s in (0, 32)]


def word_counts(texts: DataFrame) -> np.ndarray:
    """How often the words of each bucket occur in all texts, on a scale that is exact up to 3 and logarithmic past it.

    Each task sends its counts as ``_SEGMENTS`` compressed pieces, which are
    summed piece by piece; ``BUCKETS`` bytes come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, part in _slices(batch):
                np.add.at(held, _words(part)[0] & (BUCKETS - 1), 1)
        yield _sent(held)

    def on_scale(n: np.ndarray) -> np.ndarray:
        return np.where(n <= 3, n, 3 + 4 * np.log2(np.maximum(n, 3) / 3)).astype(np.uint8)

    return _gathered(texts.sparkSession, texts.mapInArrow(count, "seg int, part binary"), "<i8", np.add, on_scale, BUCKETS // _SEGMENTS)


#: A posting: word, set (a hash and a bitmap's first 64 bits), the bitmap's other bits, first place known, words in the set, place of the
#: word in the order by rarity.
_BITMAP = ("bm", "b2", "b3", "b4")
_POSTING = np.dtype([("h", "<i8"), ("k", "<i8"), *[(b, "<i8") for b in _BITMAP], ("doc", "<i8"), ("no", "<i8"), ("size", "<i4"), ("pos", "<i4")])
#: Sets of so many words have bitmaps of 128 and of 256 bits, smaller ones of 64; unused bits are zero, which packs to nothing.
_WIDER = (48, 112)


#: A line: its set and its place. What the rows of the first exchange hold: postings of a group, postings that only ask there, lines, lines that go.
_LINE = np.dtype([(f, "<i8") for f in ("k", "bm", "doc", "no")])
_OWN, _ASKS, _LINES, _GONE = range(4)


def _pack(rows: np.ndarray) -> bytes:
    """The fields one after the other, each by byte planes, compressed."""
    planes = [np.ascontiguousarray(rows[f]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for f in rows.dtype.names]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes, dtype: np.dtype = _POSTING) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    out, at = np.empty(len(raw) // dtype.itemsize, dtype), 0
    for f in dtype.names:
        width = dtype[f].itemsize
        planes = raw[at : at + width * len(out)].reshape(width, len(out))
        out[f] = np.ascontiguousarray(planes.T).view(dtype[f]).reshape(-1)
        at += planes.size
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A scrambled copy of 64-bit values."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _order(h: np.ndarray, scale: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Sorts words by line, then rarity, then hash."""
    rare = scale[h & (BUCKETS - 1)]
    if len(h) and line[-1] < 1 << 19:
        key = (line << 44) | (rare.astype(np.int64) << 36) | (h >> 27)
        order = np.argsort(key)
        sure = np.diff(key[order]) != 0
        if np.all(sure | (np.diff(h[order]) == 0)):  # the key holds but the upper bits of a hash
            return order
    return np.lexsort((h, rare, line))


def _cut(ids: np.ndarray, texts: pa.Array, wanted) -> pa.Array:
    """The lines that ``wanted`` takes, by their ids and numbers, as texts of their own."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    feeds = np.flatnonzero(data[offsets[0] : offsets[-1]] == 10) + offsets[0]
    first = np.searchsorted(feeds, offsets[:-1])
    text = np.concatenate([np.arange(len(texts)), np.searchsorted(offsets, feeds, "right") - 1])
    start = np.concatenate([offsets[:-1], feeds + 1])
    no = np.concatenate([np.zeros(len(texts), np.int64), np.arange(len(feeds)) - first[text[len(texts) :]] + 1])
    end = np.minimum(np.append(feeds, offsets[-1])[np.searchsorted(feeds, start)], offsets[text + 1])
    take = wanted(ids[text, 0], no + (ids[text, 1] << _NO_BITS))
    start, size = start[take], end[take] - start[take]
    made = np.concatenate([[0], np.cumsum(size)])
    body = data[np.repeat(start - made[:-1], size) + np.arange(made[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(made), pa.py_buffer(body)])


def _sets(ids: np.ndarray, texts: pa.Array, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines that have words: a posting for every word (h, pos and the line's fields), and where each line starts."""
    h, line, text, nos = _words(texts)
    where, nos = ids[text, 0], nos + (ids[text, 1] << _NO_BITS)
    order = _order(h, scale, line)
    h, line = h[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    h, line = h[new], line[new]
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    sizes = np.diff(starts, append=len(h))
    rows = np.empty(len(h), _POSTING)
    rows["h"], rows["size"], rows["pos"] = h, sizes[line], np.arange(len(h)) - starts[line]
    if len(h):
        rows["k"] = np.add.reduceat(_mix(h, 1), starts).view(np.int64)[line]
        which = _mix(h, 2) & (np.uint64(64) << np.searchsorted(_WIDER, sizes, "right").astype(np.uint64))[line] - np.uint64(1)
        bits, which = np.uint64(1) << (which & np.uint64(63)), which >> np.uint64(6)
        for i, b in enumerate(_BITMAP):
            rows[b] = np.bitwise_or.reduceat(np.where(which == i, bits, np.uint64(0)), starts).view(np.int64)[line]
        rows["doc"], rows["no"] = where[line], nos[line]
    return rows, starts, sizes, line


def _prefix(size: np.ndarray, t: float) -> np.ndarray:
    return size - np.ceil(size * t - 1e-9).astype(np.int64) + 1


def _group(h: np.ndarray, salt: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h, 0) + salt.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)) % np.uint64(n)


def _groups_of(scale: np.ndarray, h: np.ndarray, split: int) -> np.ndarray:
    """Into how many groups the postings of each word are dealt."""
    s = scale[h & (BUCKETS - 1)].astype(np.float64)
    occurs = np.where(s <= 3, s, 3 * 2 ** ((s - 3) / 4))
    return np.clip(np.ceil(occurs / split), 1, 64).astype(np.int64)


def _packed(rows: np.ndarray, group: np.ndarray, kind: int) -> Iterator[tuple[int, bytes, int]]:
    """Rows (group, blob, kind), one for each group."""
    order = np.lexsort((rows[rows.dtype.names[0]], group))  # postings of a word side by side pack better
    rows, group = rows[order], group[order]
    cuts = np.flatnonzero(np.diff(group)) + 1
    for piece, g in zip(np.split(rows, cuts), group[np.concatenate([[0], cuts])] if len(rows) else []):
        yield int(g), _pack(piece), kind


def _dealt(rows: np.ndarray, scale: np.ndarray, n: int, split: int) -> Iterator[tuple[int, bytes, int]]:
    """The postings, packed: each to the group of its word and set, and as one that asks to the word's other groups."""
    groups = _groups_of(scale, rows["h"], split)
    own = (rows["k"].astype(np.uint64) % groups.astype(np.uint64)).astype(np.int64)
    yield from _packed(rows, _group(rows["h"], own, n), _OWN)
    many = np.flatnonzero(groups > 1)
    if len(many):
        copies = np.repeat(many, groups[many])
        salt = np.arange(len(copies)) - np.repeat(np.cumsum(groups[many]) - groups[many], groups[many])
        away = salt != own[copies]
        yield from _packed(rows[copies[away]], _group(rows["h"][copies[away]], salt[away], n), _ASKS)


_DEALT = pa.schema([("p", pa.int32()), ("blob", pa.binary()), ("kind", pa.int32())])
_DEALT_SQL = "p int, blob binary, kind int"


def _as_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, 64)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _DEALT)], schema=_DEALT)


def _bits(x: np.ndarray) -> np.ndarray:
    """How many bits are set; of a signed number, numpy counts those of its absolute value."""
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _lost(x: list[np.ndarray], y: list[np.ndarray], wide: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps ``x`` that are not set in ``y``, each pair folded to the width (0: 64 bits, 1: 128, 2: 256) of its narrower."""
    out = np.empty(len(wide), np.int64)
    for w in range(len(_WIDER) + 1):
        at = np.flatnonzero(wide == w)
        folds = [[np.bitwise_or.reduce([v[at] for v in side[i :: 1 << w]]) for i in range(1 << w)] for side in (x, y)]
        out[at] = sum(_bits(a & ~b) for a, b in zip(*folds))
    return out


def _matches(rows: np.ndarray, asks: np.ndarray, index: np.ndarray, t: float, nearest: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (asking row, earlier row) that may reach t, and the rows that could ask for more.

    ``rows`` are sorted by word, then place. Rows are compared with the one
    before, the one two before, and so on, all words at once.
    """
    found_a, found_b, more = [], [], []
    given, open_ = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
    size, after, k, *maps = (np.ascontiguousarray(rows[f]) for f in ("size", "pos", "k", *_BITMAP))
    after = size - after  # words from the shared one on
    width = np.searchsorted(_WIDER, size, "right")
    share, least = t / (1 + t), size * t - 1e-9
    heads = np.flatnonzero(np.diff(rows["h"], prepend=~rows["h"][:1]))
    rank = np.arange(len(rows)) - np.repeat(heads, np.diff(heads, append=len(rows)))  # earlier rows of the word
    at = np.flatnonzero(asks)
    for back in itertools.count(1):
        at = at[rank[at] >= back]
        if not len(at):
            break
        x, y = at, at - back
        ok = index[y] & (np.minimum(after[x], after[y]) >= np.maximum(least[x], least[y]))
        x, y = x[ok], y[ok]
        sx, sy = size[x], size[y]
        need = np.ceil((sx + sy) * share - 1e-9)
        ok = (np.minimum(after[x], after[y]) >= need) & ~((k[x] == k[y]) & (maps[0][x] == maps[0][y]))
        x, y, sx, sy, need = x[ok], y[ok], sx[ok], sy[ok], need[ok]
        bx, by, wide = [m[x] for m in maps], [m[y] for m in maps], np.minimum(width[x], width[y])
        ok = (sx - _lost(bx, by, wide) >= need) & (sy - _lost(by, bx, wide) >= need)
        hit = x[ok]
        if nearest is not None:
            full = given[hit] >= nearest
            more.append(hit[full])
            open_[hit[full]] = False
            at = at[open_[at]]
            hit = hit[~full]
            given[hit] += 1
        found_a.append(hit)
        found_b.append(hit - back)
    cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return cat(found_a), cat(found_b), cat(more)


def _firsts(rows: np.ndarray, only: np.ndarray, keep_all: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word's postings of one set the first place, by word and place; whether it asks, and whether it may be found."""
    order = np.lexsort((rows["no"], rows["doc"], rows["h"]))
    rows, only = rows[order], only[order]
    key = _mix(_mix(_mix(rows["h"], 6) + rows["k"].view(np.uint64), 7) + rows["bm"].view(np.uint64), 8)
    by = np.argsort(key, kind="stable")
    same = key[by][1:] == key[by][:-1]
    met = np.ones(len(same), bool)
    for f in ("h", "k", "bm"):
        met &= rows[f][by][1:] == rows[f][by][:-1]
    if np.any(same & ~met):  # two sets with one key
        by = np.lexsort((rows["bm"], rows["k"], rows["h"]))
        met = np.logical_and.reduce([rows[f][by][1:] == rows[f][by][:-1] for f in ("h", "k", "bm")])
    start = np.flatnonzero(np.concatenate([[True], ~met]))
    asks = np.ones(len(start), bool) if keep_all else np.logical_or.reduceat(only[by], start)
    index = np.logical_or.reduceat(~only[by], start)
    back = np.argsort(by[start])
    return rows[by[start][back]], asks[back], index[back]


#: What comes of a group: kind, x asks, y is earlier (null in a row that says that x could ask for more), the rest of x's posting, or a blob.
_FIELDS = ("k", "bm", "doc", "no")
_MORE = ("h", "size", "pos", *_BITMAP[1:])
_FOUND = pa.schema([("kind", pa.string()), *[(f"{f}{s}", pa.int64()) for s in "xy" for f in _FIELDS], *[(f, pa.int32() if f in ("size", "pos") else pa.int64()) for f in _MORE], ("p", pa.int32()), ("blob", pa.binary())])
_FOUND_SQL = ", ".join(f"{f.name} { {pa.string(): 'string', pa.int32(): 'int', pa.int64(): 'long', pa.binary(): 'binary'}[f.type]}" for f in _FOUND)


def _found(kind: str, x: np.ndarray | None = None, y: np.ndarray | None = None, more: np.ndarray | None = None, p: int | None = None, blob: bytes | None = None) -> pa.RecordBatch:
    n = len(x) if x is not None else 1
    cols = {"kind": [kind] * n, "p": [p] * n, "blob": [blob] * n}
    for rows, names, end in ((x, _FIELDS, "x"), (y, _FIELDS, "y"), (more, _MORE, "")):
        if rows is not None:
            cols |= {f"{f}{end}": np.ascontiguousarray(rows[f]) for f in names}
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)


def _copies(lines: np.ndarray) -> np.ndarray:
    """The lines that are later than the first of their set."""
    lines = lines[np.lexsort((lines["no"], lines["doc"], lines["bm"], lines["k"]))]
    new = np.ones(len(lines), bool)
    new[1:] = (lines["k"][1:] != lines["k"][:-1]) | (lines["bm"][1:] != lines["bm"][:-1])
    first = lines[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return lines[(lines["doc"] != first["doc"]) | (lines["no"] != first["no"])]


def _ask(dealt: DataFrame, n: int, t: float, nearest: int | None) -> DataFrame:
    """What the groups of ``dealt`` hold: pairs of postings that may match; lines that go (kind gone, as x).

    If a posting could ask for more than ``nearest``: it (kind more), and the postings of its word there (kind post).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        lines = [np.empty(0, _LINE)]
        for batch in batches:
            for p, blob, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _GONE:
                    yield _found("gone", _unpack(blob, _LINE))
                elif kind == _LINES:
                    lines.append(_unpack(blob, _LINE))
                else:
                    held.setdefault(p, []).append((blob, kind == _ASKS))
        gone = _copies(np.concatenate(lines))
        del lines
        for i in range(0, len(gone), 20_000):
            yield _found("gone", gone[i : i + 20_000])
        for p in sorted(held):
            parts = [(_unpack(blob), asks) for blob, asks in held.pop(p)]
            rows, only = np.concatenate([r for r, _ in parts]), np.concatenate([np.full(len(r), a) for r, a in parts])
            del parts
            rows, asks, index = _firsts(rows, only, nearest is not None)
            a, b, more = _matches(rows, asks, index, t, nearest)
            for i in range(0, len(a), 20_000):
                yield _found("pair", rows[a[i : i + 20_000]], rows[b[i : i + 20_000]])
            if len(more):
                x = rows[np.unique(more)]
                yield _found("more", x, more=x, p=p)
                aside = rows[index & np.isin(rows["h"], x["h"])]
                for i in range(0, len(aside), 100_000):
                    yield _found("post", p=p, blob=_pack(aside[i : i + 100_000]))

    return dealt.repartitionById(n, F.col("p")).mapInArrow(run, _FOUND_SQL)


#: Copies of the words of a set that many pairs hold, each for its share of the pairs.
_SALTS = 32


def _verified(texts: DataFrame, pairs: DataFrame, scale: np.ndarray, t: float) -> DataFrame:
    """(k, bm, doc, no) of the asking sets of ``pairs`` that reach t, from the words of both lines.

    Sets that hold more than their share of the pairs are salted; with n
    partitions there are at most 8 n of them.
    """
    spark = texts.sparkSession
    pairs = store(pairs.select(*[f"{f}{s}" for s in "xy" for f in _FIELDS]).distinct(), "lines-pairs")
    places = pairs.select("docx", "nox").union(pairs.select("docy", "noy"))
    shared, again = spark.sparkContext.broadcast(scale), spark.sparkContext.broadcast(_marks(places, _FILTER, _place_bits))

    def wanted(doc: np.ndarray, no: np.ndarray) -> np.ndarray:
        return np.logical_and(*[_marked(again.value, at) for at in _place_bits(doc, no)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, part in _slices(batch):
                lines = _cut(ids, part, wanted)
                rows, starts, _, _ = _sets(np.zeros((len(lines), 2), np.int64), lines, shared.value)
                if len(rows):
                    sets = np.split(np.ascontiguousarray(rows["h"]), starts[1:])
                    heads = [pa.array(np.ascontiguousarray(rows[f][starts])) for f in ("k", "bm")]
                    yield pa.RecordBatch.from_arrays([*heads, pa.array([np.sort(s).tobytes() for s in sets], pa.binary())], names=["k", "bm", "words"])

    # rows that share an id bring a line more than once, and the filter lets some lines through
    made = store(texts.mapInArrow(read, "k long, bm long, words binary"), "lines-words")
    words = made.groupBy("k", "bm").agg(F.any_value("words").alias("words"))
    share = pairs.count() / (4 * shuffle_partitions(spark))
    sides = pairs.select(F.col("kx").alias("k"), F.col("bmx").alias("bm")).union(pairs.select("ky", "bmy"))
    heavy = F.broadcast(store(sides.groupBy("k", "bm").count().where(F.col("count") > F.lit(max(share, _SALTS))).select("k", "bm", F.lit(True).alias("heavy")), "lines-heavy"))
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    words = words.join(heavy, ["k", "bm"], "left").select("k", "bm", "words", F.explode(salts).alias("salt"))
    both = pairs
    for s, other in ("xy", "yx"):
        named = lambda frame: frame.withColumnsRenamed({c: f"{c}{s}" for c in frame.columns})  # noqa: B023, E731
        salt = F.when(F.col(f"heavy{s}"), F.pmod(F.xxhash64(f"k{other}", f"bm{other}"), F.lit(_SALTS))).otherwise(F.lit(0)).cast("int")
        both = both.join(named(heavy), [f"k{s}", f"bm{s}"], "left").withColumn(f"salt{s}", salt)
        both = both.join(named(words), [f"k{s}", f"bm{s}", f"salt{s}"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(4), batch.column(5)):
                a, b = (np.frombuffer(v.as_buffer(), "<i8") for v in (x, y))
                shared_words = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(shared_words >= t * (len(a) + len(b) - shared_words) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=list(_FIELDS)).filter(pa.array(keep, pa.bool_()))

    return both.select(*[f"{f}x" for f in _FIELDS], "wordsx", "wordsy").mapInArrow(verify, ", ".join(f"{f} long" for f in _FIELDS)).distinct()


def _content(id_col: str, text_col: str) -> list[Column]:
    """128 bits of a row's id and text."""
    return [F.xxhash64(F.lit(s), F.col(id_col).cast("long"), F.col(text_col)).alias(n) for s, n in ((1, "ka"), (2, "kb"))]


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc")


def _ranks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(ka, kb, rank) for the texts of all ids that have several rows, written; None if there is no such id.

    Ranks are by content alone: null ids after a real id of the same number,
    then by hash. The hashes of an id are numbered range by range.
    """
    keyed = docs.select(_doc(id_col), F.col(id_col).isNull().alias("none"), *_content(id_col, text_col))
    rows = store(keyed.groupBy("doc", "none", "ka", "kb").agg(F.count(F.lit(1)).alias("n")), "lines-content")
    many = store(rows.groupBy("doc").agg(F.sum("n").alias("n")).where("n > 1").select("doc"), "lines-ids")
    if many.isEmpty():
        return None
    rows = rows.drop("n").join(many, "doc", "left_semi").withColumn("range", F.shiftright("ka", 64 - _RANGE_BITS))
    sizes = rows.groupBy("doc", "none", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("doc").orderBy("none", "range").rowsBetween(Window.unboundedPreceding, -1))
    starts = store(sizes.select("doc", "none", "range", F.coalesce(before, F.lit(0)).alias("start")), "lines-ranges")
    within = F.row_number().over(Window.partitionBy("doc", "none", "range").orderBy("ka", "kb")) - 1
    ranked = rows.withColumn("within", within).join(starts, ["doc", "none", "range"]).withColumn("rank", F.col("start") + F.col("within"))
    fits = F.when(F.col("rank") < 1 << 32, F.col("rank")).otherwise(F.raise_error(F.lit("an id, or null, has more than 2**32 texts")).cast("long"))
    return store(ranked.select("ka", "kb", fits.alias("rank")), "lines-ranks")


def _by_row(docs: DataFrame, id_col: str, text_col: str, threshold: float, shown: list[Column]) -> DataFrame:
    """(row: struct of ``shown``, removed, or null) for every row of ``docs``, each a document of its own.

    Order and removal are as in :func:`removed_lines`, with rows of one id (or
    of none) in the order of their hash. Of rows equal in id and text one comes
    first; the others lose all lines that have words.
    """
    own, zero = F.struct(*shown).alias("row"), F.lit(0).cast("long")
    texts = docs.select(_doc(id_col), F.col(text_col).cast("binary").alias("text"), *_content(id_col, text_col))
    ranks = _ranks(docs, id_col, text_col)
    if ranks is None:
        gone = store(_removed(texts.select("doc", "text", zero.alias("rank")), threshold), "lines-removed")
        return docs.select(own, _doc(id_col)).join(gone, "doc", "left").select("row", "removed")
    placed = store(texts.join(ranks, ["ka", "kb"], "left").select("doc", "text", F.coalesce("rank", zero).alias("rank")), "lines-placed")
    gone = store(_removed(placed, threshold), "lines-removed")
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    worded = F.filter(F.transform(lines, lambda s, i: F.when(s.rlike(WORD), i)), lambda i: i.isNotNull())
    rows = store(docs.select(own, _doc(id_col), *_content(id_col, text_col), worded.alias("worded"), F.monotonically_increasing_id().alias("copy")), "lines-rows")
    firsts = rows.groupBy("ka", "kb").agg(F.min("copy").alias("least"))
    known = rows.join(firsts, ["ka", "kb"]).join(ranks, ["ka", "kb"], "left").withColumn("rank", F.coalesce("rank", zero))
    found = known.join(gone, ["doc", "rank"], "left")
    return found.select("row", F.when((F.col("copy") > F.col("least")) & (F.size("worded") > 0), F.col("worded")).when(F.col("copy") == F.col("least"), F.col("removed")).alias("removed"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc, removed: sorted array of line numbers from 0) for the documents that lose lines.

    Lines are parted by a line feed; a line's set is its distinct words, parted
    by ASCII white space, as written. A line goes if an earlier line, in (id,
    line) order, has a Jaccard similarity of ``threshold`` or more, whether or
    not that one goes too. Lines without words stay. Null and empty texts have
    no lines to lose. Rows that share an id count as one document: neither is
    earlier, and a line number that goes, goes in all of them. Null ids come
    last.
    """
    zero = F.lit(0).cast("long").alias("rank")
    keyed = docs.select(_doc(id_col), F.col(text_col).cast("binary").alias("text"), zero)
    back = F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc")
    return _removed(keyed, threshold).select(back, "removed")


def _removed(keyed: DataFrame, threshold: float) -> DataFrame:
    """(doc, rank, removed) for the documents (doc, text, rank) that lose lines."""
    t = threshold
    spark = keyed.sparkSession
    n, split = shuffle_partitions(spark), SPLIT
    small_batches(spark)
    scale = word_counts(keyed.select("doc", "text"))
    shared = spark.sparkContext.broadcast(scale)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple] = {}
        held: list[np.ndarray] = []
        lines: list[np.ndarray] = []
        gone: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield from _as_batches(_dealt(np.concatenate(held), shared.value, n, split))
                firsts, copies = np.concatenate(lines), np.concatenate(gone)
                yield from _as_batches(_packed(firsts, _mix(firsts["k"], 3) % np.uint64(n), _LINES))
                yield from _as_batches(_packed(copies, _mix(copies["doc"], 3) % np.uint64(n), _GONE))
            for parts in (held, lines, gone):
                parts.clear()

        for batch in batches:
            for ids, text in _slices(batch):
                rows, starts, sizes, line = _sets(ids, text, shared.value)
                if not len(rows):
                    continue
                heads = np.empty(len(starts), _LINE)
                for f in _LINE.names:
                    heads[f] = rows[f][starts]
                # a set that this task has seen at an earlier place has its postings already
                if len(seen) > 500_000:
                    seen.clear()
                fresh, later = np.zeros(len(heads), bool), np.zeros(len(heads), bool)
                for j, (k, bm, *place) in enumerate(heads.tolist()):
                    place = tuple(place)
                    known = seen.get((k, bm))
                    if known is None or place < known:
                        seen[k, bm] = place
                        fresh[j] = True
                    else:
                        later[j] = place != known
                single = shared.value[rows["h"] & (BUCKETS - 1)] == 1  # the only such word there is
                held.append(rows[fresh[line] & (rows["pos"] < _prefix(rows["size"].astype(np.int64), t)) & ~single])
                lines.append(heads[fresh])
                gone.append(heads[later])
                if sum(map(len, held)) > 270_000:
                    yield from flush()
        yield from flush()

    first = store(_ask(keyed.mapInArrow(write, _DEALT_SQL), n, t, NEAREST), "lines-asked")
    alike = store(_verified(keyed, first.where("kind = 'pair'"), scale, t), "lines-alike")
    more = first.where("kind = 'more'").join(alike.select(F.col("k").alias("kx"), F.col("bm").alias("bmx")), ["kx", "bmx"], "left_anti")
    more = store(more.select(*[F.col(f"{f}x").alias(f) for f in _FIELDS], *_MORE, "p"), "lines-more")
    if not more.isEmpty():
        alike = store(alike.union(_second(keyed, first.where("kind = 'post'").select("p", "blob"), more, scale, n, t)).distinct(), "lines-alike")

    # a pair has the first place of its sets, as every task sends all postings of a set that is new to it
    gone = first.where("kind = 'gone'").select(F.col("docx").alias("doc"), F.col("nox").alias("no")).union(alike.select("doc", "no"))
    no = F.col("no").bitwiseAND(F.lit((1 << _NO_BITS) - 1)).cast("int")
    return gone.groupBy("doc", F.shiftright("no", _NO_BITS).alias("rank")).agg(F.array_sort(F.collect_set(no)).alias("removed"))


def _second(keyed: DataFrame, posts: DataFrame, more: DataFrame, scale: np.ndarray, n: int, t: float) -> DataFrame:
    """The sets of ``more`` (postings that no near line settled) that match any of all earlier postings of their words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.empty(batch.num_rows, _POSTING)
            for c, f in enumerate(_POSTING.names):
                rows[f] = batch.column(c).to_numpy()
            yield from _as_batches(_packed(rows, batch.column("p").to_numpy(), _ASKS))

    dealt = posts.withColumn("kind", F.lit(_OWN)).union(more.select(*_POSTING.names, "p").mapInArrow(ask, _DEALT_SQL))
    pairs = store(_ask(dealt, n, t, None), "lines-asked")
    return _verified(keyed, pairs, scale, t)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, by_row: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) for every row of ``docs``.

    By id, as :func:`removed_lines` says, or ``by_row``, as :func:`_by_row` says.
    """
    n = F.regexp_count(F.col(text_col), F.lit("\n")) + 1
    shown = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.when(F.length(text_col) > 0, n), F.lit(0)).alias("n_lines")]
    if by_row:
        out = _by_row(docs, id_col, text_col, threshold, shown).select("row.*", "removed")
    else:
        gone = store(removed_lines(docs, id_col, text_col, threshold), "lines-removed")
        rows = docs.select(*shown)
        out = rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc"]), "left")
    some = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(some).alias("n_removed"), some.alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with each row's removed lines (:func:`_by_row`) cut out of its text; columns as they came."""
    out = _by_row(docs, id_col, text_col, threshold, [docs[c] for c in docs.columns])
    text = F.col("row")[text_col]
    left = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("removed", i)), "\n")
    cut = F.when(F.col("removed").isNull(), text).otherwise(left)
    return out.select(*[(cut if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
