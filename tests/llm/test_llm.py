"""The operators against brute force, exact round trips and odd inputs."""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vialflow.llm import chat, decontam, imatch, mixing, planes, quality, queries, sepscan, simhash, warc
from vialflow.llm.common import connected_components
from vialflow.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BIG = "wort " * 30_000
ODD = [
    (1, None, "en", "s", None), (2, "", None, None, 0), (3, "One two  three\tfour", "en", "s", 0), (3, "One two  three\tfour", "en", "s", 0),
    (4, BIG, "en", "t", 1), (5, "ONE two three four", "en", "s", 9), (None, "one two three four", "en", None, 1), (6, " \n\t ", "en", "t", 1),
]


def odd(spark):
    """Odd rows with columns that clash with what the operators make."""
    return spark.createDataFrame(ODD, DOCS).withColumns({c: F.lit("x") for c in ("fp", "tile", "id", "a", "b", "k", "size", "copies", "row", "component_id", "word", "doc", "item")})


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def naive_fp(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps: dict[int, int], radius: int = 2) -> dict[int, int]:
    label = {i: i for i in fps}
    for _ in fps:
        moved = False
        for i, j in itertools.combinations(fps, 2):
            if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                moved = True
        if not moved:
            break
    return label


def test_simhash_against_all_pairs(spark):
    rows = docs(spark).collect()
    fps = {r.doc_id: naive_fp(r.text) for r in rows}
    want = {i: (f"{fps[i]:016x}", c) for i, c in components(fps).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("blocks", [4, 8, 16])
def test_simhash_links_connect_all_pairs_within_radius(spark, blocks, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 16)
    rng = np.random.default_rng(blocks)
    base = rng.integers(0, 1 << 63, 20, dtype=np.int64)
    near = [int(b) ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63))) for b in base for _ in range(8)]
    fps = sorted({*map(int, base), *near})
    made = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, blocks)
    roots = {r.node: r.root for r in connected_components(made).collect()}
    want = components({f: f for f in fps})
    assert {f: roots.get(f, f) for f in fps} == want


def test_simhash_odd_rows(spark):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd(spark)).collect()), key=repr)
    assert len(got) == len(ODD)
    same = f"{naive_fp('one two three four'):016x}"
    assert got.count((3, same, 3)) == 2 and (5, same, 3) in got and (None, same, 3) in got
    assert {(i, "0" * 16, 1) for i in (1, 2, 6)} <= set(got)
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "3", "4", "None"]
    assert simhash.near_duplicates(odd(spark).limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Ids that occur with several texts, exact copies, null ids: no unique text is lost and no copy stays."""
    import corpus_pipeline

    near, alone, other = "one two three four", "quite another text that nobody else has", "and a third one, only under a null id"
    rows = [(3, near, "s"), (3, near, "s"), (5, alone, "s"), (5, near.upper(), "s"), (None, near, "t"), (None, other, "t"), (None, other, "t"), (7, "five", None), (7, "FIVE", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ka string")
    kept = corpus_pipeline.keep_one(spark, frame, "")
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == frame.columns and set(got) <= set(rows)
    assert sorted((str(i), t.lower()) for i, t, _ in got) == sorted([("3", near), ("5", alone), ("None", other), ("7", "five")])
    wide = simhash.keep_one(frame)
    assert (5, alone) in {(r.doc_id, r.text) for r in wide.collect()} and (5, near.upper()) not in {(r.doc_id, r.text) for r in wide.collect()}
    assert corpus_pipeline.keep_one(spark, frame.limit(0), "").count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in connected_components(chain).collect()} == {0}


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    extra = [(900, "u", None), (901, None, ""), (902, "u", "ä"), (903, "u", "ä"), (903, "u", "ä"), (None, "u", "ä"), (None, "v", "only"), (905, "z", BIG)]
    pages = pages.union(spark.createDataFrame(extra, pages.schema)).withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    path = scratch_path(spark, "t-warc")
    warc.write_archive(pages, path)
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {b: min((i for i, c in rows if c == b and i is not None), default=None) for _, b in rows}
    want = []
    for i, b in rows:
        revisit = first[b] is not None and i != first[b]
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[b] if revisit else None))
    assert sorted(map(repr, map(tuple, warc.digest_rows(spark, path).collect()))) == sorted(map(repr, want))
    made = warc.reconstruct(spark, path).collect()
    assert sorted((str(r.page_id), bytes(r.payload)) for r in made) == sorted((str(i), b) for i, b in rows)
    for r in made:
        body = b"" if "WARC-Type: revisit" in r.headers else bytes(r.payload)
        assert bytes(r.record) == r.headers.encode() + b"\r\n" + body + b"\r\n\r\n" and f"Content-Length: {len(body)}\r\n" in r.headers
    assert spark.read.parquet(f"{path}/payloads").count() == len({b for _, b in rows})


def test_warc_small_payloads_are_responses(spark):
    path = scratch_path(spark, "t-warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string"), path, min_revisit_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in warc.digest_rows(spark, path).collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    empty = scratch_path(spark, "t-warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.digest_rows(spark, empty).count() == 0


def test_damaged_payload_is_noticed(spark):
    path = scratch_path(spark, "t-warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string"), path)
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"ax")).write.parquet(f"{path}/other/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/other/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.digest_rows(spark, f"{path}/other").collect()


def words_of(text):
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def test_decontamination_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    w = words_of(items[0][1])
    rows += [(1000, "x " + " ".join(w[:-2]).upper() + " y"), (1001, " ".join(w[: len(w) // 2])), (1002, None), (1003, "Drei Worte hier, ja"), (1004, BIG + items[3][1]), (None, items[4][1])]
    items += [(900, "drei worte hier"), (901, ""), (902, None), (903, "x"), (904, "a b a b a b a b a b a b")]

    def grams(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for (d, t), (i, q) in itertools.product(rows, items):
        qw = words_of(q)
        if qw:
            n = min(5, len(qw))
            need = grams(qw, n)
            if len(need & grams(words_of(t), n)) >= 0.8 * len(need) - 1e-9:
                want.add((d, i, len(need), len(need & grams(words_of(t), n))))
    a = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(5)).withColumn("w", F.lit(5))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    got = {tuple(r)[:4] for r in decontam.contaminated(a, b).collect()}
    assert got == want and (1000, 0) in {g[:2] for g in got}
    kept = decontam.decontaminate(a, b)
    assert kept.columns == a.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d not in {g[0] for g in want})
    assert decontam.contaminated(a, b.limit(0)).count() == 0 and decontam.contaminated(a.limit(0), b).count() == 0


def test_imatch_edits_and_likeness(spark):
    rows = sorted((r.doc_id, r.text or "") for r in docs(spark).collect())
    got = {r.doc_id: r for r in queries.op5_imatch(spark, SF).collect()}
    assert len(got) == len(rows)
    by_text: dict = {}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        m = len(t) // 4
        edited = t[: len(t) - m] + nxt[:m]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == t:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    near = np.array([(r.near_edited, r.near_next) for r in got.values()])
    assert near[:, 0].mean() > near[:, 1].mean() + 0.25, near.mean(axis=0)


def family(terms, inside):
    """A fingerprint's parts by a plain loop: for each level, for each chain, the set of the terms in that lexicon."""
    return [[frozenset(t for t in terms if j <= inside[t][c]) for c in range(imatch.CHAINS)] for j in range(imatch.LEVELS + 1)]


def test_imatch_large_lexicon(spark, monkeypatch):
    """A lexicon over the bound is shuffled, with the same rows."""
    d = docs(spark).limit(60)
    known = imatch.lexicon(docs(spark))
    want = sorted(imatch.with_edited(d, known=known).collect())
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", 0)
    assert sorted(imatch.with_edited(d, known=known).collect()) == want


def test_imatch_fingerprint_by_hand(spark):
    """Both operators agree; hashes are equal where, and only where, the sets of a lexicon's terms are; likeness as a plain loop finds it."""
    d = docs(spark)
    known = imatch.lexicon(d)
    one = {r.doc_id: r.fingerprint for r in imatch.fingerprints(d, known=known).collect()}
    two = {r.doc_id: r for r in imatch.with_edited(d, known=known).collect()}
    assert one == {i: r.fingerprint for i, r in two.items()}
    n = d.count()
    terms = {r.doc_id: r.t for r in d.select("doc_id", imatch.distinct_terms(F.col("text")).alias("t")).collect()}
    df: dict = {}
    for t in itertools.chain.from_iterable(terms.values()):
        df[t] = df.get(t, 0) + 1
    band = {t for t, c in df.items() if 0.001 * n <= c <= 0.1 * n}
    assert {r.term for r in known.collect()} == band
    # the deepest level that a term reaches in each chain
    reached = [sum((F.when(imatch.in_lexicon(F.col("term"), c, j), 1).otherwise(0) for j in range(1, imatch.LEVELS + 1)), F.lit(0)) for c in range(imatch.CHAINS)]
    inside = {r.term: list(r.of) for r in known.select("term", F.array(*reached).alias("of")).collect()}
    there, back = {}, {}
    for i, ts in terms.items():
        ts = [t for t in ts if t in band]
        if not ts:
            assert one[i].startswith("--:")
            continue
        whole, *levels = one[i].split("/")
        want = [level for level in family(ts, inside)[1:] if any(level)]
        assert there.setdefault(frozenset(ts), whole) == whole and back.setdefault(whole, frozenset(ts)) == frozenset(ts)
        assert len(levels) == len(want)
        for shown, level in zip(levels, want):
            assert len(shown.split(",")) == imatch.CHAINS
            for c, (e, of) in enumerate(zip(shown.split(","), level)):
                assert (e == "-") == (not of)
                assert not of or (there.setdefault((c, of), e) == e and back.setdefault((c, e), of) == of)

    def share(x: str, y: str) -> float:
        if x == y:
            return 1.0
        none = ["-"] * imatch.CHAINS
        a, b = ([e.split(",") for e in f.split("/")[1:]] for f in (x, y))
        told = [(p, q) for p, q in itertools.zip_longest(a, b, fillvalue=none) if "-" in p + q]
        told = [(u, v) for p, q in told or zip(a, b) for u, v in zip(p, q) if (u, v) != ("-", "-")]
        return sum(u == v for u, v in told) / (len(told) + 1)

    order = sorted(two)
    for k, i in enumerate(order):
        assert two[i].near_edited == pytest.approx(share(one[i], two[i].edited_fingerprint), abs=1e-6)
        assert two[i].near_next == pytest.approx(share(one[i], one[order[(k + 1) % len(order)]]), abs=1e-6)


def test_imatch_tells_one_term(spark):
    """One term left out changes the whole band's hash and some lexicons, never all; texts without a term of the band stand for themselves."""
    d = docs(spark)
    known = imatch.lexicon(d)
    terms = {r.doc_id: r.t for r in d.select("doc_id", imatch.distinct_terms(F.col("text")).alias("t")).collect()}
    long = max(terms, key=lambda i: len(terms[i]))
    words = d.where(F.col("doc_id") == long).select(F.explode(F.array_distinct(imatch.terms(F.col("text")))).alias("w")).withColumn("t", F.xxhash64("w"))
    band = [r.w for r in words.join(known, words["t"] == known["term"]).select("w").orderBy("w").limit(40).collect()]
    rows = [(k, " ".join(band[:k] + band[k + 1 :])) for k in range(len(band))] + [(99, " ".join(band)), (100, " ".join(reversed(band))), (101, "zzzzq"), (102, "zzzzr"), (103, None)]
    made = {r.doc_id: r.fingerprint for r in imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), known=known).collect()}
    assert made[99] == made[100] and len({made[k] for k in (99, 101, 102, 103)}) == 4
    of = lambda f: [e for level in f.split("/")[1:] for e in level.split(",")]
    for k in range(len(band)):
        equal = [x == y for x, y in zip(of(made[k]), of(made[99])) if x != "-"]
        assert made[k].split("/")[0] != made[99].split("/")[0] and 0 < sum(equal) < len(equal)
    pairs = spark.createDataFrame([(made[99], made[100]), (made[99], made[0]), (made[101], made[102]), (made[101], made[99])], "x string, y string")
    got = [r.v for r in pairs.select(imatch.likeness(F.col("x"), F.col("y")).alias("v")).collect()]
    assert got[0] == 1 and 0.3 < got[1] < 1 and got[2:] == [0, 0]


def test_imatch_odd_rows(spark):
    got = imatch.with_edited(odd(spark)).collect()
    assert len(got) == len(ODD) and len({r.fingerprint for r in got if r.doc_id == 3}) == 1
    assert imatch.with_edited(odd(spark).limit(0)).count() == 0 and imatch.with_edited(odd(spark).where("doc_id = 4")).count() == 1
    assert len(imatch.fingerprints(odd(spark)).collect()) == len(ODD)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        assert (planes.from_planes(planes.to_planes(ids, kind), n, kind) == ids).all()


def encoded(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(("kind", "block"), [("byte", 65536), ("bit", 64)])
def test_token_planes_against_the_library(spark, kind, block, monkeypatch):
    monkeypatch.setattr(planes, "BLOCK_IDS", block)
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()][:120]
    rows += [(-5, None), (700, ""), (701, "a<|endoftext|>b it's  ÀB x y é ́z 12"), (702, BIG), (703, "a"), (703, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit(1)).withColumn("id", F.lit(1))
    path = scratch_path(spark, "t-planes")
    planes.write_ids(frame, path, queries.vocabulary(), 1, kind)
    start, want = 0, []
    for (i, _), ids in zip(sorted(rows, key=lambda r: r[0]), encoded([t or "" for _, t in sorted(rows, key=lambda r: r[0])])):
        ids = [*ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = sorted(tuple(r) for r in planes.read_ids(spark, path, digest=True).collect())
    assert got == sorted(w[:4] for w in want)
    assert sorted((r.doc_id, r.start, list(r.ids)) for r in planes.read_ids(spark, path).collect()) == sorted((w[0], w[1], w[4]) for w in want)
    none = scratch_path(spark, "t-planes")
    planes.write_ids(frame.limit(0), none, queries.vocabulary())
    assert planes.read_ids(spark, none, digest=True).count() == 0


def test_mix_targets():
    assert mixing.targets([10, 10, 10], [3, 1, 2], 45) == pytest.approx([20, 25 / 3, 50 / 3])
    assert mixing.targets([1, 100], [3, 1], 150) == pytest.approx([2, 148])
    assert mixing.targets([0, 0], [1, 1], 0) == [0, 0] and mixing.targets([], [], 0) == []
    assert mixing.targets([5, 5], [1, 1], 100) == [10, 10]


def test_mixing_totals_and_expectation(spark):
    got = queries.op7_mixing(spark, SF).collect()
    rows = docs(spark).collect()
    size = {r.doc_id: len((r.text or "").encode().split()) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    order = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sums = [sum(size[i] for i in size if source[i] == s) for s in order]
    goal = dict(zip(order, mixing.targets(sums, [[3, 1, 2][i % 3] for i in range(len(order))], 1.5 * sum(sums))))
    assert {r.doc_id: r.size for r in got} == size
    for s in order:
        mine = [r for r in got if source[r.doc_id] == s]
        assert all(r.target == pytest.approx(goal[s]) and r.source_size == sums[order.index(s)] for r in mine)
        assert abs(sum(r.taken for r in mine) - goal[s]) <= max(r.size for r in mine) + 1e-6
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
    again = mixing.mix(docs(spark).repartition(5)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_pivotal_rounding_keeps_mass_and_odds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    rows = [(i, i % 7 + 1, 0.1 + 0.05 * (i % 9)) for i in range(60)]
    frame = spark.createDataFrame([(0, (i, 0, 1), float(w), p) for i, w, p in rows], "src int, key struct<a:long,b:long,k:int>, w double, p double")
    ups = np.zeros(60)
    for seed in range(6):
        got = {r.key.a: r.up for r in mixing.pivotal(frame, {0: 60}, seed * 10).collect()}
        assert sorted(got) == list(range(60))
        assert abs(sum(w for i, w, _ in rows if got[i]) - sum(w * p for _, w, p in rows)) <= 7
        ups += [got[i] for i in range(60)]
    assert abs(ups.sum() / 6 - sum(p for *_, p in rows)) < 4


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd(spark)).collect()
    assert len(got) == len(ODD) and {r.size for r in got if r.doc_id in (1, 2, 6)} == {0}
    kept = mixing.mixed(odd(spark))
    assert kept.columns == odd(spark).columns
    words = sum(len((r.text or "").encode().split()) for r in kept.collect())
    assert words == sum(r.taken for r in got)
    assert mixing.mix(odd(spark).limit(0)).count() == 0 and mixing.mixed(odd(spark).limit(0)).count() == 0


def test_token_counts_against_the_library(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()] + [(900, None), (901, ""), (902, "x<|endoftext|>y"), (None, BIG), (3, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("file", F.lit(1)).withColumn("ids", F.lit(1))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    t.encode_special_tokens = True
    want = sorted(((i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows), key=repr)
    for block in (50, 1 << 18):
        path = scratch_path(spark, "t-flat")
        sepscan.write_flat(frame, path, queries.vocabulary(), 49407, block_ids=block)
        assert sorted(map(tuple, sepscan.count_tokens(spark, path, 49407).collect()), key=repr) == want


def test_separator_scan_against_a_loop(spark):
    rng = np.random.default_rng(3)
    want, blocks = [], []
    for file in range(4):
        ids = rng.integers(0, 6, 200 * file).astype("<u2")
        parts = np.split(ids, np.flatnonzero(ids == 0) + 1)
        want += [(file, k, len(p) - 1, True) for k, p in enumerate(parts[:-1])] + [(file, len(parts) - 1, len(parts[-1]), False)] * bool(len(parts[-1]))
        blocks += [(file, b, bytearray(ids[i : i + 37].tobytes())) for b, i in enumerate(range(0, len(ids), 37))] + [(file, 999, None)]
    got = sepscan.scan(spark.createDataFrame(blocks, "file long, block long, ids binary"), 0)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sepscan.scan(spark.createDataFrame([], "file long, block long, ids binary"), 0).count() == 0


@pytest.mark.parametrize("bits", [0, 2])
def test_separator_scan_in_ranges(spark, bits, monkeypatch):
    """Documents that end ranges later than they start, blocks in any order, no file, no block number, clashing columns."""
    monkeypatch.setattr(sepscan, "RANGE_BITS", bits)
    rng = np.random.default_rng(5)
    want, blocks = [], []
    for file in (None, 0, 7):
        ids = rng.integers(0, 90, 1500).astype("<u2")
        parts = np.split(ids, np.flatnonzero(ids == 0) + 1)
        want += [(file, k, len(p) - 1, True) for k, p in enumerate(parts[:-1])] + [(file, len(parts) - 1, len(parts[-1]), False)] * bool(len(parts[-1]))
        blocks += [(file, b or None, bytearray(ids[i : i + 11].tobytes())) for b, i in enumerate(range(0, len(ids), 11))]
    blocks = [blocks[i] for i in rng.permutation(len(blocks))]
    frame = spark.createDataFrame(blocks, "file long, block long, ids binary").repartition(5).selectExpr("*", "1 as at", "2 as range", "3 as start", "4 as n", "5 as doc0", "6 as rf")
    assert sorted(map(tuple, sepscan.scan(frame, 0).collect()), key=repr) == sorted(want, key=repr)


def test_chat_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 2)
    convs = {r.conv_id: [] for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role, r.text))
    base = convs[0]
    convs |= {1000 + n: base[:n] for n in range(1, len(base))} | {2000: base, 2001: [*base, ("user", None)], 2002: [*base, ("user", "")], 2003: [(None, "x")], 2004: [("", "x")]}
    convs[None] = [("user", "null id"), ("user", "null id")]
    rows = [(c, 3 * k + 1, r, t) for c, ts in convs.items() for k, (r, t) in enumerate(ts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(1)).withColumn("a", F.lit(1)).withColumn("conv", F.lit("y"))
    firsts: dict = {}
    for c, ts in convs.items():
        firsts[tuple(ts)] = min((x for x in (c, firsts.get(tuple(ts))) if x is not None), default=None)
    inner = {tuple(ts[:k]) for ts in convs.values() for k in range(1, len(ts))}
    want = {(c, len(ts)) for ts, c in firsts.items() if ts not in inner}
    assert {tuple(r) for r in chat.maximal(frame).collect()} == want
    shown = chat.rendered_turns(frame).collect()
    assert len(shown) == sum(n for _, n in want) and {r.conv_id for r in shown} == {c for c, _ in want}
    assert chat.rendered_turns(frame.limit(0)).count() == 0


def test_rules_come_from_tree_paths():
    text = "x\n  If (feature 3 <= 0.5)\n   If (feature 0 <= 2.0)\n    Predict: 1.0\n   Else (feature 0 > 2.0)\n    Predict: 0.0\n  Else (feature 3 > 0.5)\n   Predict: 1.0\n"
    assert quality.paths(text) == [((3, "<=", 0.5),), ((3, "<=", 0.5), (0, "<=", 2.0)), ((3, "<=", 0.5), (0, ">", 2.0)), ((3, ">", 0.5),)]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op10_quality(spark, sf).collect()}
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[i].predicted, q) for i, q in y.items() if i in got and got[i].held_out]
    assert np.mean([p == q for p, q in held]) > 0.9, held


def test_quality_odd_rows(spark):
    d = docs(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(d, labels)
    got = quality.scored(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.accepted(odd(spark), model).columns == odd(spark).columns
    none = quality.fit(d, labels.limit(0))
    assert {r.score for r in quality.scored(odd(spark), none).collect()} == {0.5}
    ones = quality.fit(d, labels.where("quality = 1"))
    assert all(r.score > 0.9 for r in quality.scored(odd(spark), ones).collect())
    assert quality.scored(odd(spark).limit(0), model).count() == 0


def test_plain_words_encode_as_the_library_does():
    from vialflow.llm.tokens import Encoder

    encoder = Encoder(queries.vocabulary(), False)
    assert encoder.words.plain
    words = ["Ä", "ÀÖØöøÿßÞ!", "é...", "İx", "J̌", "áb", "x's", "'tis", "<|endoftext|>", "ab<|endoftext|>", "ABC_`^~", "ſ", "Åb{}", "ª", "×", "÷a", "日本。", "3a", "A1!", "--", "a­b", "ßẞ", "Ελλάς"]
    words += [chr(c) + tail for c in range(0x21, 0x250) if not chr(c).isspace() for tail in ("", "x", "!?")]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(words, add_special_tokens=False)]
    assert encoder.encode([w.encode() for w in words]) == want
    assert encoder.encode([w.encode() for w in words]) == want  # from the cache
