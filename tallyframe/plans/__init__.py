"""Query plans over the driver's tables: importing the modules registers their queries."""

from . import q_aggs, q_columns, q_joins, q_sources, q_stats, q_windows  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
