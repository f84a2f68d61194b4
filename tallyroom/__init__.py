"""tallyroom: e-commerce analytics marts as distributed PySpark jobs.

Raw users, orders and click events go in; cleaned tables, session and
customer rollups, and three marts (daily revenue, cohort retention, funnel)
come out.  Every operator takes and returns Spark DataFrames.
"""
