"""tagloom — corpus analytics, text features, classifiers, topics and auto-tagging on Spark DataFrames.

Every operator is a plain function ``(DataFrame, params) -> DataFrame``; the heavy work is declared with the
DataFrame API (or ``pyspark.ml``) so Catalyst plans it and executors run it.
"""

__version__ = "0.1.0"
