"""Parameterised Spark SQL over the LIMS tables.

Users who keep their extraction as SQL text run it here: tables are bound
as DataFrames (``{NAME}`` placeholders, no global temp views), and the one
named parameter ``:trial_code`` is bound only when a code is given, like
the original job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import LimsTables
from ..sqltext import run

#: A sample of user text: what a trial's ledger moved at each location, by month of receipt.
MONTHLY_SQL = """
SELECT moved.LOCATIONCODE, trunc(seen.DATE_RECEIVED, 'MM') AS RECEIVED_MONTH,
       count(*) AS N_MOVES, sum(moved.AMOUNTLEFT) AS AMOUNT
FROM {CENTRALRECEIVING_VLA} seen
  JOIN {INVENTORY_VLA} tube ON tube.EXTERNAL_ID = seen.EXTERNAL_ID
  JOIN {INVENTORY_TRANSACTIONS_VLA} moved ON moved.INVENTORYID = tube.INVENTORYID
WHERE seen.LAST_NAME = :trial_code
GROUP BY moved.LOCATIONCODE, trunc(seen.DATE_RECEIVED, 'MM')
"""


def run_sql(spark: SparkSession, text: str, tables: LimsTables, trial_code: str | None = None) -> DataFrame:
    """Run ``text`` with ``{TABLE}`` bound to ``tables`` and ``:trial_code`` bound if given."""
    return run(spark, text, tables, {"trial_code": trial_code} if trial_code else None)
