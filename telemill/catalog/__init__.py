"""The registered queries, each over the given tables, with its SQL where there is one."""

from telemill.catalog.base import Query
from telemill.catalog import dashboards, features, learning, rows, statistics, streams, tables

ALL: list[Query] = [q for part in (dashboards, rows, features, statistics, tables, streams, learning) for q in part.QUERIES]
