"""Row-level transforms: own cases for each rule, among them the semantics
rules (NULL / NaN / regex dialect / rounding) a naive port gets wrong."""

from __future__ import annotations

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from vialflow.functions.predicates import flag_viable, not_in
from vialflow.functions.scalar import grid_ordinal, safe_int
from vialflow.functions.text import extract_labels, extract_sampleid, redact_dsn_password, redact_labelled, slug
from vialflow.operators.summary import viability_by, viability_summary
from vialflow.sinks.parquet import history_path, parquet_path, slug_text


def test_extract_sampleid_like_python(spark):
    """Comments put together from fragments: what Python's ``re.search`` finds first, or NULL."""
    parts = ["SAMPLEID:q7/2,", "SAMPLEID: ,", "sampleid:low,", "LAB_ID:0042", "LAB_ID:x9", "drawn twice;", "SAMPLEID:open"]
    texts = [" ".join(p) for n in range(4) for p in itertools.permutations(parts, n)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, COMMENTS string")
    first = lambda rx, t: (m := re.search(rx, t)) and m[1]
    got = {r.i: (r.SAMPLEID, r.SAMPLEID2) for r in extract_sampleid(df).collect()}
    assert got == {i: (first(r"SAMPLEID:(.*?),", t), first(r"LAB_ID:(\d+)", t)) for i, t in enumerate(texts)}


def test_extract_sampleid_null_vs_empty_and_dialect(spark):
    df = spark.createDataFrame(
        [(0, "SAMPLEID:, LAB_ID:7"),        # empty capture stays '' (N5)
         (1, "SAMPLEID:noend"),             # no comma: no match -> NULL
         (2, "SAMPLEID:a\rb, x"),           # Python '.' crosses \r (N6)
         (3, "SAMPLEID:a\nb, x"),           # ...but not \n
         (4, "LAB_ID:٣٤x"),       # Unicode digits are \d in Python (N6)
         (5, None)],
        "i int, COMMENTS string",
    )
    rows = {r.i: r for r in extract_sampleid(df).collect()}
    assert rows[0].SAMPLEID == "" and rows[0].SAMPLEID2 == "7"
    assert rows[1].SAMPLEID is None
    assert rows[2].SAMPLEID == "a\rb"
    assert rows[3].SAMPLEID is None
    assert rows[4].SAMPLEID2 == "٣٤"
    assert rows[5].SAMPLEID is None and rows[5].SAMPLEID2 is None


# Every mix of these, with what each on its own says about a vial.
MATCODES = {"Cryobox 9x9": True, "100x100Box": False, "100x100box": True, "": True, None: False}
RECEIVED = {"Intact": True, "QNSR": False, "qnsr": True, None: True}  # N1: no condition is none of the listed
CONDITIONS = {"Thawed once": True, "NSI": False, None: True}
AMOUNTS = {0.25: True, 0.0: False, -3.5: False, None: False, float("nan"): False}  # N3: NaN is missing
VIABLE_ROWS = [
    (m, r, c, a, MATCODES[m] and RECEIVED[r] and CONDITIONS[c] and AMOUNTS[a]) for m, r, c, a in itertools.product(MATCODES, RECEIVED, CONDITIONS, AMOUNTS)
]


def test_flag_viable_cases(spark):
    df = spark.createDataFrame(
        [(i, *r[:4]) for i, r in enumerate(VIABLE_ROWS)],
        "i int, MATCODE string, RECEIVED_CONDITION string, SAMPLE_CONDITION string, AMOUNTLEFT double",
    )
    out = {r.i: r.VIABLE for r in flag_viable(df, ["QNSR", "NSI"], ["100x100Box"]).collect()}
    assert out == {i: r[4] for i, r in enumerate(VIABLE_ROWS)}
    # N2: None in the material list must not poison it; N12: never NULL
    with_none = flag_viable(df, ["QNSR", "NSI"], ["100x100Box", None])
    assert with_none.where(F.col("VIABLE").isNull()).count() == 0
    assert {r.i: r.VIABLE for r in with_none.collect()} == out
    assert flag_viable(df).count() == df.count()  # never drops rows


def test_not_in_nullsafe(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    got = df.select("x", not_in("x", ["a"]).alias("plain"), not_in("x", ["a", None]).alias("with_null")).collect()
    assert {(r.x, r.plain, r.with_null) for r in got} == {("a", False, False), ("b", True, True), (None, True, False)}


def test_safe_int_cast(spark):
    cases = {" 12 ": 12, "+5": 5, "-7": -7, "1.5": None, "1e3": None, "2147483648": None, "": None, "A1": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.n for r in df.select("s", safe_int("s").alias("n")).collect()}
    assert got == cases
    zero = df.select("s", safe_int("s", empty_as_zero=True).alias("n")).where(F.col("s") == "").first()
    assert zero.n == 0


def test_grid_ordinal(spark):
    df = spark.createDataFrame([(1, 1, 9), (2, 3, 9), (None, 1, 9), (2, 1, None)], "y int, x int, w int")
    assert [r.p for r in df.select(grid_ordinal("y", "x", "w").alias("p")).collect()] == [1, 12, None, None]


def test_redact_reference_case(spark):
    dsn = "Driver={ODBC Driver 17 for SQL Server};Server=myServer;Database=myDB;UID=myUser;PWD=secretPassword123;"
    df = spark.createDataFrame([(dsn,), ("pwd=a;PWD=b;x",)], "s string")
    out = [r.r for r in df.select(redact_dsn_password("s").alias("r")).collect()]
    assert "PWD=****" in out[0] and "secretPassword123" not in out[0] and "UID=myUser" in out[0]
    assert out[1] == "pwd=****;PWD=****;x"  # case-insensitive, every occurrence


def test_redact_labelled_quotes(spark):
    df = spark.createDataFrame([('a token = "s3cr3t" b TOKEN = "x"',)], "s string")
    assert df.select(redact_labelled("s", 'token = "', '"').alias("r")).first().r == 'a token = "****" b TOKEN = "****"'


def test_slug_and_paths(spark, tmp_path):
    df = spark.createDataFrame([("TRIAL-001",), ("A_B",), ("A-B",), ("***",), ("MIDDLE EAST",)], "c string")
    assert [r.s for r in df.select(slug("c").alias("s")).collect()] == ["TRIAL_001", "A_B", "A_B", "", "MIDDLE_EAST"]
    assert slug_text("TRIAL-001") == "TRIAL_001"
    out = str(tmp_path / "output")
    assert parquet_path("TRIAL-001", out, False, False) == f"{out}/TRIAL_001.parquet"
    assert "TRIAL_001_PROD" in parquet_path("TRIAL-001", out, True, False)
    nested = parquet_path("TRIAL-001", out, False, True)
    assert nested.rsplit("/", 1)[0] == f"{out}/TRIAL-001"  # raw, un-slugged sub-folder
    assert history_path(f"{out}/X.parquet") == f"{out}/X_history.parquet"


def test_extract_labels(spark):
    df = spark.createDataFrame([("http://a.example.com/x?page=12",), ("https://b.example.org/",)], "url string")
    got = extract_labels(df, "url", {"PAGE": r"page=(\d+)", "HOST": r"://(.*?)\.example"}).collect()
    assert [(r.PAGE, r.HOST) for r in got] == [("12", "a"), (None, "b")]


def test_viability_summary_rounding_and_empty(spark):
    rows = [(i < 1,) for i in range(8)]  # 7 of 8 not viable: 87.5 -> 87.5
    df = spark.createDataFrame(rows, "VIABLE boolean")
    s = viability_summary(df).first()
    assert (s.NOT_VIABLE, s.TOTAL, s.PCT_NOT_VIABLE) == (7, 8, 87.5)
    ties = spark.createDataFrame([(i >= 1,) for i in range(800)], "VIABLE boolean")  # 1/800 = 0.125 -> 0.12 (half-even)
    assert viability_summary(ties).first().PCT_NOT_VIABLE == 0.12
    empty = viability_summary(df.where("false")).first()
    assert (empty.NOT_VIABLE, empty.TOTAL, empty.PCT_NOT_VIABLE) == (0, 0, 0.0)


def test_viability_by_reasons(spark):
    df = spark.createDataFrame(
        [("s1", *r[:4]) for r in VIABLE_ROWS], "SITE string, MATCODE string, RECEIVED_CONDITION string, "
        "SAMPLE_CONDITION string, AMOUNTLEFT double",
    )
    flagged = flag_viable(df)
    r = viability_by(flagged, ["SITE"]).first()
    assert r.TOTAL == len(VIABLE_ROWS)
    n = len(VIABLE_ROWS)
    assert r.N_MATCODE_MISSING == r.N_MATCODE_EXCLUDED == n // len(MATCODES)
    assert r.N_RECEIVED_CONDITION_EXCLUDED == n // len(RECEIVED) and r.N_SAMPLE_CONDITION_EXCLUDED == n // len(CONDITIONS)
    assert r.N_AMOUNT_MISSING == r.N_AMOUNT_NOT_POSITIVE == 2 * n // len(AMOUNTS)
    assert math.isclose(r.PCT_NOT_VIABLE, round(r.NOT_VIABLE / r.TOTAL * 100, 2))


@pytest.mark.parametrize("value", ["SAMPLEID:ABC, LAB_ID:12", "x"])
def test_no_python_udf_in_transforms(spark, value):
    df = spark.createDataFrame([(value, "Box", "Good", "Good", 1.0)],
                               "COMMENTS string, MATCODE string, RECEIVED_CONDITION string, "
                               "SAMPLE_CONDITION string, AMOUNTLEFT double")
    plan = flag_viable(extract_sampleid(df))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_cluster_conf_keeps_explicit_settings(spark):
    from vialflow.session import CLUSTER_CONF, apply_cluster_conf

    before = set(spark.conf.getAll)
    try:
        apply_cluster_conf(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # the session's explicit value is kept
        key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        assert spark.conf.get(key) == CLUSTER_CONF[key]
    finally:
        for key in set(CLUSTER_CONF) - before:
            spark.conf.unset(key)


def test_slug_transliterates_like_driver_side(spark):
    cases = ["TRIAL-001", "Ünïcödé-001", "Straße 1,000", "A,B", "***", "Łódź", "Œuvre", "  x__y  "]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = [r.s for r in df.select(slug("c").alias("s")).collect()]
    assert got == [slug_text(c) for c in cases]
    assert got[:4] == ["TRIAL_001", "Unicode_001", "Strasse_1000", "A_B"]


def test_percent_rounds_like_python_on_false_ties(spark):
    from vialflow.operators.summary import percent

    # 107/4000*100 prints as 2.675 but is slightly less: Python gives 2.67 (bround would give 2.68)
    pairs = [(107, 4000), (1, 4000), (3, 4000), (13, 4000), (19, 4000), (21, 4000), (1, 8), (1, 800), (2, 3), (0, 7)]
    df = spark.createDataFrame(pairs, "bad long, total long")
    got = {(r.bad, r.total): r.p for r in df.select("bad", "total", percent(F.col("bad"), F.col("total")).alias("p")).collect()}
    assert got == {(b, t): round(b / t * 100, 2) for b, t in pairs}
    assert got[(107, 4000)] == 2.67
