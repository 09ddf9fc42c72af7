"""All queries of the library on the test tables, and the SQL of each."""

from strainflow.plans import bundle, catalogue, composition, denominator, laboratory, report, specs

MODULES = [catalogue, composition, bundle, specs, denominator, laboratory, report]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
