"""Composed plans: the three batch jobs and the operator catalog that runs
each operator over the given tables (with an equivalent SQL text)."""
