"""Credit-portfolio analytics on Spark DataFrames.

Cohort default-rate analyses, portfolio scoring with Spark ML, decision and
report columns, and feedback ingestion (batch or streaming), all written as
DataFrame expressions that Catalyst plans and Spark distributes.
"""

__version__ = "0.1.0"
