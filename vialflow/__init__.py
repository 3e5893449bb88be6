"""vialflow: specimen-inventory extraction as Spark DataFrame / SQL plans.

Main entry points::

    from vialflow import (read_parquet_tables, trial_extract, trial_inventory,
                          inventory_history, extract_trial, extract_trials)

See README.md for the plan design and the operator map.
"""

from .plans.history import inventory_history
from .plans.inventory import materialize_trial_vials, trial_extract, trial_inventory
from .plans.sql_text import run_sql
from .sinks.parquet import extract_trial, extract_trials
from .sources.tables import LimsTables, read_jdbc_tables, read_parquet_tables

__all__ = [
    "LimsTables", "read_parquet_tables", "read_jdbc_tables", "trial_inventory", "trial_extract",
    "inventory_history", "materialize_trial_vials", "extract_trial", "extract_trials", "run_sql",
]
