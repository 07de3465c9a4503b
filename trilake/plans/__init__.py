"""Composite plans: raw -> trusted cleaning, the business questions (DataFrame and
SQL variants), dashboard KPIs and the look-alike trusted tables used by the contract."""
