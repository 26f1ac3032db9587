"""Every operator and job, run on the shared test tables, next to the SQL it must agree with.

The tables stand in for the athlete data: `customer` is the reference table (``c_custkey`` the
athlete, ``c_acctbal`` a measure), `orders` and `events` are facts.
"""

from podium.checks.queries import QUERIES
from podium.checks.sql import SQL

__all__ = ["QUERIES", "SQL"]
