"""The registered queries over the given tables, each next to the SQL that states its result.

Results are rounded on both sides because sums of floats depend on the order of their terms.
"""

from tidewatch.plans.catalog import evaluation, features, forests, models, nonfinite, outputs, quality, sources

_MODULES = (sources, features, quality, evaluation, models, forests, nonfinite, outputs)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
