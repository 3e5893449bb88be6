"""The database reader's statements and predicates, run on an embedded database; and quantile cuts."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from vialflow.sources import tables as src
from vialflow.sources.tables import ReadPoint


def ledger(rows: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    columns = ", ".join(f"{c} VARCHAR" for c in src.COLUMNS["INVENTORY"] if c != "INVENTORYID")
    con.execute(f"CREATE TABLE INVENTORY (INVENTORYID BIGINT, {columns}, CHANGED INTEGER DEFAULT 0)")
    con.execute(f"INSERT INTO INVENTORY (INVENTORYID) {rows}")
    return con


def reads(con, n, point=src.LIVE):
    """The rows of each parallel read."""
    lows = [r[0] for r in con.execute("SELECT * FROM " + src.jdbc_split_query("INVENTORY", n, point)).fetchall()]
    predicates = src.jdbc_split_predicates("INVENTORY", lows)
    return [con.execute(f"SELECT * FROM {src.jdbc_query('INVENTORY', point)} WHERE {p}").fetchall() for p in predicates]


def test_two_far_clusters_are_cut_evenly():
    con = ledger("SELECT range FROM range(1, 10001) UNION ALL SELECT 1000000000 + range FROM range(1, 3001)")
    parts = reads(con, 64)
    sizes = [len(p) for p in parts]
    assert len(sizes) == 64 and sum(sizes) == 13_000 and len({r[0] for p in parts for r in p}) == 13_000
    assert max(sizes) < 2 * 13_000 / 64 and min(sizes) > 13_000 / 64 / 2


@pytest.mark.parametrize("rows, n_parts", [
    ("SELECT NULL FROM range(5)", 1), ("SELECT 7 FROM range(100)", 1), ("SELECT range % 3 FROM range(100) UNION ALL SELECT NULL FROM range(4)", 3), ("SELECT 1 WHERE 1 = 0", 1),
])
def test_each_row_is_read_once(rows, n_parts):
    con = ledger(rows)
    parts = reads(con, 64)
    assert len(parts) == n_parts and sum(map(len, parts)) == con.execute("SELECT count(*) FROM INVENTORY").fetchone()[0]


def test_rows_outside_old_cuts_are_read_too():
    con = ledger("SELECT range FROM range(-50, 500)")
    predicates = src.jdbc_split_predicates("INVENTORY", [0, 100, 200])
    found = [con.execute(f"SELECT count(*) FROM INVENTORY WHERE {p}").fetchone()[0] for p in predicates]
    assert found == [150, 100, 300]


def test_one_read_point_for_all_partitions():
    con = ledger("SELECT range FROM range(1000)")
    point = ReadPoint.change_column("CHANGED", "3")
    before = reads(con, 8, point)
    con.execute("INSERT INTO INVENTORY (INVENTORYID, CHANGED) SELECT range, 4 FROM range(500, 2500)")
    assert reads(con, 8, point) == before and sum(map(len, reads(con, 8))) == 3000
    assert src.jdbc_query("ROOMS", ReadPoint.system_time("2024-05-01T00:00:00")) == (
        "(SELECT ROOM_ID, ROOM_NAME, ROOM_CODE, BUILDING_ID FROM ROOMS FOR SYSTEM_TIME AS OF '2024-05-01T00:00:00') q")
    assert "FROM lims_0501.dbo.ROOMS)" in src.jdbc_query("ROOMS", ReadPoint.database_snapshot("lims_0501"))
    assert "o''clock" in src.jdbc_query("ROOMS", ReadPoint.change_column("C", "o'clock"))


def test_quantile_splits_of_a_frame(spark):
    ids = spark.range(1, 20_001).union(spark.range(10**9, 10**9 + 5000)).withColumn("id", F.when(F.col("id") % 977 == 0, None).otherwise(F.col("id")))
    cuts = src.quantile_splits(ids, "id", 64)
    assert cuts == sorted(cuts) and len(cuts) == 64
    predicates = [p.replace("INVENTORYID", "id") for p in src.jdbc_split_predicates("INVENTORY", cuts)]
    sizes = [ids.where(p).count() for p in predicates[:3] + predicates[-3:]] + [0]
    whole = ids.select(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(predicates)]).first()
    assert sum(whole) == 25_000 and max(whole) < 2 * 25_000 / 64 and sizes[0] == whole[0]
    assert src.quantile_splits(ids.limit(0), "id", 64) == []


def test_reader_options(spark, monkeypatch):
    """What the reader asks Spark for, without a server."""
    asked: list = []

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return spark.createDataFrame([(i * 10,) for i in range(64)], "LOW long")

        def jdbc(self, url, table, predicates=None, properties=None):
            asked.append({"dbtable": table, "predicates": predicates, **properties})
            return spark.range(1)

    class Session:
        read = Reader()

    t = src.read_jdbc_tables(Session(), "jdbc:x", {"user": "u"}, names=["INVENTORY", "METADATA", "ROOMS"], read_point=ReadPoint.database_snapshot("s"))
    assert set(t) == {"INVENTORY", "METADATA", "ROOMS"}
    split, inventory, metadata, rooms = asked
    assert "NTILE(64)" in split["dbtable"] and len(inventory["predicates"]) == 64 and inventory["fetchsize"] == "10000"
    assert len(metadata["predicates"]) == 64 and "predicates" not in rooms and all("s.dbo." in a["dbtable"] for a in asked)
    asked.clear()
    src.read_jdbc_tables(Session(), "jdbc:x", {}, names=["INVENTORY"], bounds={"INVENTORY": (1, 9)}, num_partitions=4)
    assert asked[0]["numPartitions"] == "4" and asked[0]["upperBound"] == "10"
    asked.clear()
    src.read_jdbc_tables(Session(), "jdbc:x", {}, names=["INVENTORY"], splits={"INVENTORY": [0, 5, 9]})
    assert len(asked) == 1 and asked[0]["predicates"][1] == "INVENTORYID >= 5 AND INVENTORYID < 9"
