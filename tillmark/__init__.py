"""Sales analytics over point-of-sale exports, as plain Spark jobs.

Raw CSV exports are loaded into Bronze, gated by quality checks, refined into two Silver
tables (orders, costed order lines), summarised in four Gold marts and exported as reports.
"""
