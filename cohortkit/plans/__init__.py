"""Composed plans: the monthly lead plan, the query registry and the SQL oracle."""
