"""Every operator as a query over the given tables, next to equivalent SQL where there is one."""

from lakepipe.queries import evaluation, features, ingest, keys, models, quality, star

MODULES = (star, ingest, keys, quality, features, evaluation, models)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
