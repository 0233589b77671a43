"""ledgerline: retail order analytics expressed as Spark DataFrame plans.

Subpackages:
  sources    -- readers, writers and the order-line fact view
  functions  -- column-expression helpers (pure ``Column`` builders)
  operators  -- analytical queries, data-quality rules, features, metrics, models
  plans      -- skew-safe window plans and the query/oracle registry
  streaming  -- the order-scoring Structured Streaming job
"""

__version__ = "0.1.0"
