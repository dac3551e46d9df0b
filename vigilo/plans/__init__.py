"""Composed plans: the registered queries, their SQL twins and the batch job."""
