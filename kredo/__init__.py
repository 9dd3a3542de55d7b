"""kredo: corporate credit-risk analytics written as Spark DataFrame jobs.

Filings (nested rubric arrays) and company-register dimensions go in; a
staging table of ratios, a 3-year training table, risk labels, segments and
pyspark.ml models come out.  Every step is a DataFrame -> DataFrame function.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
