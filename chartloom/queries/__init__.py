"""Ready-made queries over the given tables, each next to the SQL that checks it."""

from chartloom.queries import documents, entities, evidence, extraction, monitoring, review, storage

MODULES = (documents, extraction, entities, evidence, review, monitoring, storage)
QUERIES = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
