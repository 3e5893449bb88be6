"""Fixed-size sketches that shape the large joins, stated as Spark SQL.

* A **Bloom reducer** cuts a large table to (about) the rows whose key is in
  a set of ids, whatever the size of the set. The filter is a relation: one
  row for each 64-bit word in use, ``(WORD, BITS)``. A key picks one word and
  three bits of it, so testing a row is one broadcast hash join on a long plus
  a mask, inside the scan's code-generated stage. ``words`` bounds the rows
  and so the broadcast; a fuller filter only lets more rows through to the
  exact join that follows.
* A **heavy-hitter sketch** (mergeable frequent-items counts) names the keys
  that hold the most rows. Their dimension rows, at most ``HEAVY_KEYS`` for
  each shuffle partition, are broadcast; all other rows go through the shuffle
  join, which has no hot key left.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.text import collation_key_sql, plain_collation
from ..sources.tables import LimsTables
from ..sqltext import hint

#: Words (rows) of a Bloom filter: 8 MB of bits, some 50 MB as a broadcast relation.
DEFAULT_WORDS = 1 << 20
CONF_WORDS = "vialflow.bloom.words"
#: The largest number of words that the setting may ask for: the broadcast stays bounded.
MAX_WORDS = 1 << 22
#: Compressed bytes of the large tables together from which sketches are worth their own scans; below, nothing is hot or large.
DEFAULT_MIN_BYTES = 64 * 1024 * 1024
CONF_MIN_BYTES = "vialflow.bloom.minBytes"
#: Keys joined apart for each shuffle partition, and the buckets that their sketches are dealt to.
HEAVY_KEYS = 4
HEAVY_BUCKETS = 64

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def bloom_words(spark: SparkSession) -> int:
    raw = spark.conf.get(CONF_WORDS, None)
    return max(1, min(int(raw) if raw else DEFAULT_WORDS, MAX_WORDS))


def worth_reducing(t: LimsTables, names) -> bool:
    """Whether tables ``names`` are large enough together for reducers."""
    raw = t.spark.conf.get(CONF_MIN_BYTES, None)
    return sum(t.table_bytes(n) for n in names) >= (int(raw) if raw else DEFAULT_MIN_BYTES)


def comparable_key(left: str, right: str, collation: str | None = None) -> str | None:
    """How both sides of an equality are hashed alike: a pattern, or ``None`` where they can't be.

    Equal values must have equal hashes. Integers of any width are widened;
    other types must be the same plain type on both sides. Floating point and
    collated strings have equal values with unequal bytes.
    """
    if left in _INTEGRAL and right in _INTEGRAL:
        return "CAST({} AS BIGINT)"
    if left == right == "string":
        return collation_key_sql("{}", collation) if plain_collation(collation) else None
    if left == right and (left == "date" or left.startswith(("decimal", "timestamp"))):
        return "{}"
    return None


def _hash(key: str) -> str:
    return f"xxhash64({key})"


def _mask(h: str) -> str:
    bits = (f"shiftleft(1L, CAST(shiftrightunsigned({h}, {at}) & 63 AS INT))" for at in (40, 46, 52))
    return " | ".join(bits)


def bloom_sql(key: str, source: str, words: int) -> str:
    """The filter ``(WORD, BITS)`` over the non-null values of ``key`` in ``source``."""
    return f"""SELECT pmod(H, {words}) AS WORD, bit_or({_mask("H")}) AS BITS
        FROM (SELECT {_hash(key)} AS H FROM {source} WHERE {key} IS NOT NULL) k GROUP BY pmod(H, {words})"""


def bloom_join(name: str, alias: str, key: str, words: int) -> str:
    """``JOIN`` clause that keeps the rows whose ``key`` may be in filter ``name``; never repeats a row."""
    h = _hash(key)
    return f"JOIN {name} {alias} ON {alias}.WORD = pmod({h}, {words}) AND ({alias}.BITS & ({_mask(h)})) = ({_mask(h)})"


class Reducers:
    """The Bloom filters of one statement: CTEs to state, hints and joins to use them.

    ``keep(table, column, name)`` gives ``(hint alias, join clause)`` that cuts
    ``table`` by filter ``name``, or empty strings where the key types can't be
    hashed alike (the exact joins alone then do the work).
    """

    def __init__(self, t: LimsTables, collation: str | None = None) -> None:
        self.t, self.words, self.collation = t, bloom_words(t.spark), collation
        self._made: dict[str, tuple[str, str]] = {}

    def add(self, name: str, key: str, key_type: str, source: str) -> None:
        """State filter ``name`` over ``key`` (of SQL type ``key_type``) of ``source``."""
        cast = comparable_key(key_type, key_type, self.collation)
        if cast:
            self._made[name] = (key_type, f"{name} AS ({bloom_sql(cast.format(key), source, self.words)})")

    def extend(self, other: Reducers) -> None:
        """Take over the filters of ``other`` (their CTEs are stated elsewhere)."""
        self._made.update(other._made)

    def ctes(self) -> str:
        """The CTEs, each followed by a comma."""
        return "".join(f"{text},\n" for _, text in self._made.values())

    def keep(self, table: str, column: str, name: str, alias: str) -> tuple[str, str]:
        """Hint and join that cut ``alias`` (rows of ``table``) by filter ``name``."""
        if name not in self._made:
            return "", ""
        cast = comparable_key(self.t.col_type(table, column), self._made[name][0], self.collation)
        if cast is None:
            return "", ""
        return hint([f"{name}_{alias}"]), bloom_join(name, f"{name}_{alias}", cast.format(f"{alias}.{column}"), self.words)


def heavy_sql(key: str, source: str, partitions: int) -> str:
    """``(BOX_ID)``: the keys that hold the most rows of ``source``, at most ``HEAVY_KEYS`` for each task.

    Keys are dealt to buckets, each with a mergeable frequent-items sketch, so
    the sketches are merged in as many tasks and each stays small. A key with
    more rows than ``1 / HEAVY_KEYS`` of a task's mean load is among them unless
    its bucket has as many heavier ones. Which keys are named shapes the join only.
    """
    buckets = max(1, min(partitions, HEAVY_BUCKETS))
    most = max(HEAVY_KEYS, -(-HEAVY_KEYS * partitions // buckets))
    tracked = max(64, 4 * most)
    return f"""SELECT ITEM.item AS BOX_ID
        FROM (SELECT approx_top_k({key}, {most}, {tracked}) AS TOP FROM {source} WHERE {key} IS NOT NULL
              GROUP BY pmod(xxhash64({key}), {buckets})) s
        LATERAL VIEW explode(TOP) e AS ITEM"""
