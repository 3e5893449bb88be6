"""Line dedup against a comparison of all pairs of lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from vialflow.llm import linededup, queries

SF = "/root/testdata/sf0.001"


def brute(rows: list[tuple]) -> dict:
    """Removed line numbers by id; ids compare with null last."""
    order = lambda d: (1 << 63) - 1 if d is None else d
    lines = [(order(d), no, frozenset(s.encode().split())) for d, t in rows for no, s in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    first: dict = {}
    for d, no, s in lines:
        first[s] = min(first.get(s, (d, no)), (d, no))
    sets = list(first)
    late = {s for s in sets if any(len(s) >= 0.8 * len(r) and len(r) >= 0.8 * len(s) and len(s & r) >= 0.8 * len(s | r) - 1e-9 and first[r] < first[s] for r in sets)}
    out: dict = {}
    for d, no, s in lines:
        if s in late or (d, no) > first[s]:
            out.setdefault(d, set()).add(no)
    return {None if d == order(None) else d: sorted(nos) for d, nos in out.items()}


def planted() -> list[tuple]:
    base = [f"w{i}" for i in range(30)]
    rows = [(2000 + i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(30)]  # a group of near copies
    rows += [(3000 + i, f"a b c d {'e' * (i + 1)}") for i in range(12)] + [(3100, "a b c d"), (3101, "d c b a a")]
    rows += [(None, "a b c d\n\n \nlast of all"), (4000, None), (4001, ""), (4002, "last of all\nonly here"), (4003, "q " * 40_000 + "\nq"), (4003, "q\nonly here")]
    return rows


@pytest.mark.parametrize(("nearest", "split"), [(2, 1 << 16), (0, 4)])
def test_lines_against_all_pairs(spark, nearest, split, monkeypatch):
    """Also with every pair left to the second round, and frequent words dealt to many groups."""
    monkeypatch.setattr(linededup, "NEAREST", nearest)
    monkeypatch.setattr(linededup, "SPLIT", split)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + planted()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("*", "1 as k", "2 as doc", "3 as removed")
    got = linededup.line_report(frame).collect()
    want = brute(rows)
    assert {r.doc_id: list(r.removed) for r in got if r.removed} == want
    assert len(got) == len(rows) and all(r.n_removed == len(r.removed) for r in got)


def test_cut_texts_and_odd_tables(spark):
    frame = spark.createDataFrame([(1, "a b c d e\nx", "t"), (2, "y\na b c d e\n", None), (3, None, None)], "doc_id long, text string, doc string")
    cut = linededup.dedup_lines(frame)
    assert cut.columns == frame.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "a b c d e\nx", 2: "y\n", 3: None}
    assert linededup.line_report(frame.limit(0)).count() == 0 and linededup.dedup_lines(frame.limit(0)).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    """No unique line is lost, and of equal lines one stays, whatever the ids."""
    rows = [(1, "old line of words"), (None, "old line of words\nonly in x"), (None, "only in y\ntail of y"), (None, "same a b\n\nsame c d"), (None, "same a b\n\nsame c d"), (5, "five is here"), (5, "another text"), (5, "five is here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as removed", "2 as rank")
    want = sorted(["old line of words", "only in x", "only in y", "tail of y", "same a b", "same c d", "five is here", "another text"])
    cut = linededup.dedup_lines(frame)
    assert cut.columns == frame.columns and cut.count() == len(rows)
    assert sorted(s for r in cut.collect() for s in r.text.split("\n") if s) == want
    got = linededup.line_report(frame, by_row=True).collect()
    assert len(got) == len(rows) and sum(r.n_removed for r in got) == 4
    assert all(r.n_removed == len(r.removed) for r in got)


def test_line_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r.doc_id: list(r.removed) for r in queries.op2_line_dedup(spark, SF).collect() if r.removed} == brute(rows)


def test_bitmap_bound_with_the_top_bit_set():
    """Two sets of 30 words that differ in one: the bound must let them through, whatever bits are set."""
    rows = np.zeros(2, linededup._POSTING)
    rows["h"], rows["size"], rows["k"], rows["doc"] = 5, 30, [1, 2], [1, 2]
    for bits in ([0, -(1 << 63)], [1, -(1 << 63)], [-(1 << 63), 3]):
        rows["bm"] = bits
        a, b, more = linededup._matches(rows, np.ones(2, bool), np.ones(2, bool), 0.8, 2)
        assert (a.tolist(), b.tolist(), more.tolist()) == ([1], [0], [])
    assert linededup._bits(np.array([-1, -(1 << 63), -2, 3])).tolist() == [64, 1, 63, 2]


def test_packed_postings_come_back():
    rows = np.frombuffer(np.random.default_rng(3).bytes(100 * linededup._POSTING.itemsize), linededup._POSTING)
    assert (linededup._unpack(linededup._pack(rows)) == rows).all()


def test_folded_bitmaps_never_count_too_much():
    """Sets of all three widths: bits that one bitmap has and the other lacks are at most the words that it alone has."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in rng.permutation(400)]
    sets = [base[a : a + size] for size in (5, 47, 48, 60, 111, 112, 130, 300) for a in (0, 3, 40)]
    blob = pa.array([" ".join(s).encode() for s in sets], pa.large_binary())
    rows, starts, sizes, _ = linededup._sets(np.zeros((len(sets), 2), np.int64), blob, np.full(linededup.BUCKETS, 5, np.uint8))
    assert sizes.tolist() == [len(s) for s in sets]
    heads = rows[starts]
    width = np.searchsorted(linededup._WIDER, heads["size"], "right")
    assert set(width) == {0, 1, 2}
    x, y = (i.ravel() for i in np.meshgrid(range(len(sets)), range(len(sets))))
    lost = linededup._lost([heads[b][x] for b in linededup._BITMAP], [heads[b][y] for b in linededup._BITMAP], np.minimum(width[x], width[y]))
    alone = np.array([len(set(sets[i]) - set(sets[j])) for i, j in zip(x, y)])
    assert (lost <= alone).all() and lost.max() > 40


def test_cut_takes_the_lines_it_is_asked_for():
    texts = ["a b\n\nc d\n", "", "\n", "only", None, "x\ny", "tail\n"]
    ids = np.array([[10 * i, 0] for i in range(len(texts))])
    blob = pa.array([t and t.encode() for t in ["left out", *texts]], pa.large_binary()).fill_null(b"").slice(1)
    for keep in (lambda doc, no: doc >= 0, lambda doc, no: (no == 1) | (doc == 30), lambda doc, no: doc < 0):
        want = [s for i, t in enumerate(texts) for no, s in enumerate((t or "").split("\n")) if keep(10 * i, no)]
        got = linededup._cut(ids, blob, lambda doc, no: np.broadcast_to(keep(doc, no), doc.shape))
        assert sorted(v.decode() for v in got.to_pylist()) == sorted(want)


def test_sets_of_many_pairs_are_salted(spark, monkeypatch):
    """Lines that many pairs hold: their words are copied, and no match is lost or made."""
    monkeypatch.setattr(linededup, "NEAREST", 0)
    monkeypatch.setattr(linededup, "_SALTS", 3)
    monkeypatch.setattr(linededup, "shuffle_partitions", lambda spark: 40)  # so that a set of the group has more than its share
    rows = planted() + [(5000 + i, " ".join([*(f"v{j}" for j in range(20)), f"own{i}", f"more{i}", f"third{i}"][: 20 + i % 4])) for i in range(120)]
    heavy = []
    real = linededup.store
    monkeypatch.setattr(linededup, "store", lambda df, name: heavy.append(real(df, name)) or heavy[-1] if name == "lines-heavy" else real(df, name))
    got = linededup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: list(r.removed) for r in got if r.removed} == brute(rows)
    assert sum(h.count() for h in heavy) > 0
