"""All driver queries and their oracle SQL, in one place."""

from __future__ import annotations

from . import bindings, bindings_ops, bindings_rules, oracle, oracle_ops

QUERIES = {}
QUERIES.update(bindings.MART_QUERIES)
QUERIES.update(bindings_ops.OP_QUERIES)
QUERIES.update(bindings_rules.QUERIES)

_SQL = dict(oracle.SQL)
_SQL.update(oracle_ops.SQL)
_SQL.update(bindings_rules.SQL)
ORACLE_SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
