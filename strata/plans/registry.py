"""All registered queries and their checking SQL."""

from strata.plans import analytics, dimensional, facts, storage, streams

_MODULES = [dimensional, facts, analytics, storage, streams]
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
