"""All named queries and their equivalent SQL."""

from __future__ import annotations

from webtext.plans import features, logs, pages, search, streams, text

_MODULES = (pages, search, text, features, logs, streams)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: statement.strip() for module in _MODULES for name, statement in module.SQL.items()}
