"""tessera: relational analytics operators expressed as Spark DataFrame plans.

Subpackages:
  sources    -- table loading, literal sources, typed schemas, sinks and layouts
  operators  -- joins, subquery rewrites, aggregates, windows, table changes,
                data-quality validators, views / materializations, banking jobs
  functions  -- scalar helpers and parameterised table functions
  plans      -- the query registry: every operator applied to the driver tables,
                each paired with an equivalent DuckDB SQL oracle
  streaming  -- Structured Streaming versions of the daily report and alerts
"""

__version__ = "0.1.0"
