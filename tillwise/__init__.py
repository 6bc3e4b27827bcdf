"""tillwise: retail analytics as PySpark DataFrame operators.

Every public function takes and returns DataFrames.  Nothing is collected
to the driver; global scalars (totals, modes, means) enter plans as
uncorrelated scalar subqueries, which Spark evaluates once as a one-row
aggregate.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
