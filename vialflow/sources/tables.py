"""The LIMS tables the plans read, and where they come from.

Plans take a :class:`LimsTables` (name -> DataFrame) and never care whether
the frames are Parquet datasets, JDBC reads or the derived test fixtures.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns each plan touches, per source table. Readers select exactly these so
# the scan reads no other column (and a JDBC read asks the server for no more).
COLUMNS: dict[str, tuple[str, ...]] = {
    "CENTRALRECEIVING_VLA": (
        "EXTERNAL_ID", "SUBJECTID", "FIRST_NAME", "LAST_NAME", "FOLDERNO", "DATE_COLLECTED",
        "DATE_RECEIVED", "METADATA_GUID", "TRIAL_MASTER_SCHEDULE_ID", "RASCLIENTID", "ARCSTATUS", "ORIGREC",
    ),
    "INVENTORY_VLA": ("INVENTORYID", "EXTERNAL_ID", "EXTERNAL_CODE", "METADATA_GUID"),
    "INVENTORY": ("INVENTORYID", "MATCODE", "EXTERNAL_CODE", "INVENTORY_CODE"),
    "INVENTORY_TRANSACTIONS_VLA": (
        "INVENTORYID", "TRANSACTION_ID", "FLAG_CURRENT", "CONTAINER_INVENTORYID", "AMOUNTLEFT",
        "AMOUNT_UNIT_CODE", "THAWCOUNT", "CONSENT_TYPE", "LOCATIONCODE", "CONTAINER_POS_Y",
        "CONTAINER_POS_X", "COMMENTS",
    ),
    "INVENTORY_TRANSACTIONS": ("INVENTORYID", "FLAG_CURRENT", "LOCATIONCODE", "COMMENTS"),
    "SAMPLECONTAINERS_VLA": (
        "INVENTORYID", "CONTAINERID", "SAMPLETYPE", "RECEIVEDCONDITION", "CONTCODE", "CONTAINERMATCODE",
    ),
    "METADATA": (
        "ID", "FIELD01", "FIELD02", "FIELD03", "FIELD12", "FIELD13", "FIELD14", "FIELD15", "FIELD16",
        "FIELD17", "FIELD18", "FIELD20", "FIELD22", "FIELD28",
    ),
    "TRIAL_MASTER_SCHEDULE": ("TRIAL_MASTER_SCHEDULE_ID", "MSDESCRIPTION", "TRIAL_ID", "TRIAL_ELEMENT_TP_ID"),
    "TRIAL_ELEMENT_TIMEPOINT": ("TRIAL_ELEMENT_TP_ID", "CODE", "VISIT", "DESCRIPTION", "TRIAL_ELEMENT_ID"),
    "TRIAL_ELEMENT": ("TRIAL_ELEMENT_ID", "ELEMENT_NAME"),
    "TRIAL": ("TRIAL_ID", "TRIAL_CODE"),
    "MATERIALS": ("MATCODE", "CONTAINER_AXIS_X_SIZE", "CONTAINER_AXIS_Y_SIZE"),
    "CONTAINERS_CONDITION": ("CONTCODE", "PRESERVATIVE"),
    "LOCATIONS": (
        "LOCATIONCODE", "LOCATION_NAME", "PARENT_LOCATION_CODE", "ROOM_ID", "SORTER", "LONGNAME", "LONGCODE",
    ),
    "ROOMS": ("ROOM_ID", "ROOM_NAME", "ROOM_CODE", "BUILDING_ID"),
    "BUILDINGS": ("BUILDING_ID", "BUILDING_NAME", "BUILDING_CODE"),
    "TRANSACTIONS": ("TRANSACTION_ID", "TRANSACTION_DT", "USRNAM", "TRANSACTION_TYPE"),
}

TABLE_NAMES: tuple[str, ...] = tuple(COLUMNS)

# Lookup tables that are small by nature (schedules, materials, storage
# locations), and the key that each is looked up by.
DIMENSION_KEYS: dict[str, str] = {
    "TRIAL_MASTER_SCHEDULE": "TRIAL_MASTER_SCHEDULE_ID", "TRIAL_ELEMENT_TIMEPOINT": "TRIAL_ELEMENT_TP_ID",
    "TRIAL_ELEMENT": "TRIAL_ELEMENT_ID", "TRIAL": "TRIAL_ID", "MATERIALS": "MATCODE", "CONTAINERS_CONDITION": "CONTCODE",
    "LOCATIONS": "LOCATIONCODE", "ROOMS": "ROOM_ID", "BUILDINGS": "BUILDING_ID",
}
DIMENSION_TABLES = frozenset(DIMENSION_KEYS)
#: Largest estimate for which a dimension is measured at all.
MEASURE_MAX_BYTES = 1 << 30


@dataclass(frozen=True)
class Measure:
    """What one pass over a dimension has found: its rows, their bytes in memory, and whether each key occurs once."""

    rows: int
    bytes: int
    unique: bool


@dataclass
class LimsTables(Mapping[str, DataFrame]):
    """Name -> DataFrame for the 17 LIMS tables.

    Also remembers each table's size estimate and column types, which the
    plans consult (broadcast decisions, NULL-key spreading) without asking
    the JVM again for every query.
    """

    frames: dict[str, DataFrame] = field(default_factory=dict)
    _bytes: dict[str, int] = field(default_factory=dict, repr=False)
    _types: dict[str, dict[str, str]] = field(default_factory=dict, repr=False)
    _measures: dict[str | None, dict[str, Measure]] = field(default_factory=dict, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self.frames[name]
        except KeyError:
            raise KeyError(f"LIMS table {name!r} is not loaded") from None

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.frames.values())).sparkSession

    def table_bytes(self, name: str) -> int:
        """Catalyst's size estimate of the (column-pruned) table; no job runs."""
        if name not in self._bytes:
            self._bytes[name] = plan_bytes(self[name])
        return self._bytes[name]

    def measure(self, name: str, collation: str | None = None) -> Measure | None:
        """Rows, bytes and key uniqueness of dimension ``name``; ``None`` if it is no dimension, or too large to be measured.

        The first question measures every dimension, in one job: each is read
        once and sends a partial count from each task (and its keys, for the
        distinct count). The answers are kept with the tables, for each collation
        that keys are compared under.
        """
        if collation not in self._measures:
            self._measures[collation] = self._measured(collation)
        return self._measures[collation].get(name)

    def _measured(self, collation: str | None) -> dict[str, Measure]:
        from ..functions.text import collation_key_sql

        parts, frames = [], {}
        for name, key in DIMENSION_KEYS.items():
            if name not in self.frames or self.table_bytes(name) > MEASURE_MAX_BYTES:
                continue
            kinds = {c: self.col_type(name, c) for c in self[name].columns}
            size = " + ".join(f"coalesce(octet_length({c}), 0) + 16" if kind.startswith(("string", "binary")) else "16" for c, kind in kinds.items())
            key = collation_key_sql(key, collation) if kinds[key] == "string" else key
            parts.append(f"SELECT '{name}' AS NAME, count(1) AS N, count({key}) AS FILLED, count(DISTINCT {key}) AS KEYS, coalesce(sum({size}), 0) AS BYTES FROM {{{name}}}")
            frames[name] = self[name]
        if not parts:
            return {}
        found = self.spark.sql(" UNION ALL ".join(parts), **frames).collect()
        return {r.NAME: Measure(r.N, int(r.BYTES) + 64 * r.N, r.FILLED == r.KEYS) for r in found}

    def col_type(self, table: str, col: str) -> str:
        """Simple SQL type name of ``table.col`` (``bigint``, ``int``, ``string``...)."""
        if table not in self._types:
            self._types[table] = {f.name: f.dataType.simpleString() for f in self[table].schema.fields}
        return self._types[table][col]


UNKNOWN_SIZE = 1 << 62


def plan_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df``; "unknown" (never broadcast) when the
    session does not expose the plan (e.g. a Spark Connect client)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no plan access: treat as large
        return UNKNOWN_SIZE


def read_parquet_tables(spark: SparkSession, base: str, names=TABLE_NAMES) -> LimsTables:
    """One Parquet dataset per table at ``<base>/<NAME>``; column-pruned."""
    frames = {}
    for name in names:
        frames[name] = spark.read.parquet(f"{base.rstrip('/')}/{name}").select(*COLUMNS[name])
    return LimsTables(frames)


# Numeric column by whose ranges a large table is read in parallel over JDBC.
RANGE_COLUMNS = {
    "CENTRALRECEIVING_VLA": "ORIGREC", "INVENTORY_VLA": "INVENTORYID", "INVENTORY": "INVENTORYID",
    "INVENTORY_TRANSACTIONS_VLA": "INVENTORYID", "INVENTORY_TRANSACTIONS": "INVENTORYID",
    "SAMPLECONTAINERS_VLA": "INVENTORYID", "TRANSACTIONS": "TRANSACTION_ID",
}
# Large tables with a string key only: read in parallel by a hash of it.
HASH_COLUMNS = {"METADATA": "ID"}
# SQL Server's hash of a column as a number from 0; a null has one too.
HASH_EXPRESSION = "(CHECKSUM({column}) & 2147483647) % {n} = {i}"


@dataclass(frozen=True)
class ReadPoint:
    """The one moment at which every partition of every table is read.

    Parallel reads are separate transactions: without a read point a row that
    changes during the extraction may be seen before the change in one table and
    after it in another. ``source`` and ``predicate`` are patterns over
    ``{table}`` and ``{at}``; ``at`` is one literal, found or given once.
    """

    at: str
    source: str = "{table}"
    predicate: str | None = None

    @classmethod
    def system_time(cls, at: str) -> ReadPoint:
        """System-versioned tables, as they were at ``at`` (UTC)."""
        return cls(at, source="{table} FOR SYSTEM_TIME AS OF '{at}'")

    @classmethod
    def database_snapshot(cls, name: str) -> ReadPoint:
        """A database snapshot ``name`` with the same tables in schema ``dbo``."""
        return cls(name, source="{at}.dbo.{table}")

    @classmethod
    def change_column(cls, column: str, at: str) -> ReadPoint:
        """Tables whose ``column`` tells when a row came in; rows are added and not changed."""
        return cls(at, predicate=f"{column} <= '{{at}}'")

    def table(self, name: str) -> str:
        return self.source.format(table=name, at=self.at.replace("'", "''"))

    def where(self) -> str:
        return f" WHERE {self.predicate.format(at=self.at.replace(chr(39), chr(39) * 2))}" if self.predicate else ""


LIVE = ReadPoint("")
#: Sent when a connection opens: what one partition reads is then one state of the database.
SNAPSHOT_STATEMENT = "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"


def jdbc_query(name: str, point: ReadPoint = LIVE) -> str:
    return f"(SELECT {', '.join(COLUMNS[name])} FROM {point.table(name)}{point.where()}) q"


def jdbc_split_query(name: str, num_partitions: int, point: ReadPoint = LIVE) -> str:
    """The least range-column value of each of ``num_partitions`` equally large parts of the table.

    One row a part. The server reads the column once, in the order of its index;
    ids that lie in far clusters get as many parts as they have rows.
    """
    column = RANGE_COLUMNS[name]
    rows = f"SELECT {column} AS K FROM {point.table(name)}{point.where()}"
    parts = f"SELECT K, NTILE({num_partitions}) OVER (ORDER BY K) AS PART FROM ({rows}) r WHERE K IS NOT NULL"
    return f"(SELECT MIN(K) AS LOW FROM ({parts}) p GROUP BY PART) q"


def jdbc_split_predicates(name: str, lows: Sequence[int]) -> list[str]:
    """One predicate for each parallel read, from the parts' least values; each row meets exactly one.

    Parts that begin alike (one id holds several) are one. Rows before the first
    value, or without one, come with the first part, rows after the last with the
    last: bounds found earlier shape the reads only.
    """
    column = RANGE_COLUMNS[name]
    cuts = sorted({int(v) for v in lows if v is not None})[1:]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def quantile_splits(df: DataFrame, column: str, num_partitions: int) -> list[int]:
    """Values that cut ``column`` into parts of about equal size, from one mergeable sketch (KLL).

    For tables that Spark can read itself: a Parquet export, or the ids of an
    earlier extraction that shape the database reads of the next
    (``splits=`` of :func:`read_jdbc_tables`). Nothing but the sketch leaves the tasks.
    """
    ranks = ", ".join(f"{i / num_partitions}D" for i in range(num_partitions))
    row = df.where(F.col(column).isNotNull()).agg(F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), 4096).alias("s"), F.count(F.lit(1)).alias("n"))
    if not row.select("n").first()[0]:
        return []
    return [int(v) for v in row.selectExpr(f"kll_sketch_get_quantile_bigint(s, array({ranks})) AS q").first()[0]]


def jdbc_bounds_query(name: str) -> str:
    """One row: the least and greatest value of the table's range column."""
    column = RANGE_COLUMNS[name]
    return f"(SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {name}) q"


def jdbc_range_options(name: str, low: int, high: int, num_partitions: int) -> dict[str, str]:
    """Reader options for ``num_partitions`` range reads; rows without the key come with the first."""
    return {"partitionColumn": RANGE_COLUMNS[name], "lowerBound": str(int(low)), "upperBound": str(int(high) + 1),
            "numPartitions": str(num_partitions)}


def jdbc_hash_predicates(name: str, num_partitions: int, expression: str = HASH_EXPRESSION) -> list[str]:
    """One predicate for each parallel read; each row meets exactly one of them."""
    return [expression.format(column=HASH_COLUMNS[name], n=num_partitions, i=i) for i in range(num_partitions)]


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    *,
    bounds: Mapping[str, tuple[int, int]] | None = None,
    splits: Mapping[str, Sequence[int]] | None = None,
    read_point: ReadPoint = LIVE,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    hash_expression: str = HASH_EXPRESSION,
    names=TABLE_NAMES,
) -> LimsTables:
    """Read the tables over JDBC (SQL Server in the original deployment).

    Large tables are split into ``num_partitions`` reads of about as many rows,
    so that many executors pull in parallel: by ranges of a numeric id, cut at
    its quantiles (one query a table, or ``splits`` known from before), or by a
    hash of the key where it is a string. ``bounds`` (least, greatest) asks for
    ranges of equal width instead, where ids are known to lie evenly. Cuts only
    shape the ranges; rows outside them are read too. The small dimensions are
    single reads. Only the needed columns are requested.

    ``read_point`` makes all reads see one moment. The test suite runs the
    statements and predicates on an embedded database; reading through a JDBC
    driver is untested (the container has no server).
    """
    bounds, splits = bounds or {}, splits or {}
    props = {**{k: str(v) for k, v in properties.items()}, "fetchsize": str(fetch_size)}

    def load(query: str, **options: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=query, **props, **options).load()

    frames = {}
    for name in names:
        query = jdbc_query(name, read_point)
        if name in HASH_COLUMNS:
            predicates = jdbc_hash_predicates(name, num_partitions, hash_expression)
        elif name in RANGE_COLUMNS and bounds.get(name) is None:
            lows = splits.get(name)
            if lows is None:
                lows = [r[0] for r in load(jdbc_split_query(name, num_partitions, read_point)).collect()]
            predicates = jdbc_split_predicates(name, lows)
        else:
            found = bounds.get(name) if name in RANGE_COLUMNS else None
            frames[name] = load(query, **(jdbc_range_options(name, *found, num_partitions) if found else {}))
            continue
        frames[name] = spark.read.jdbc(url, query, predicates=predicates, properties=props)
    return LimsTables(frames)
