"""The operators on the star-schema test tables, each with the SQL that has to give the same rows.

Reading of the tables: orders are commits, lineitem edits, customer and supplier users, events issue events,
conversations comments, pages url carriers. What a table lacks (labels, assignees, accounts) is derived from
its columns, for all of its rows.
"""

from repolume.queries import (  # noqa: F401
    filters,
    identity,
    incremental,
    lookups,
    metrics,
    records,
    relations,
    storage,
)
from repolume.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
