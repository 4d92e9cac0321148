"""zonepulse: place-and-time incident analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small tidy
DataFrame of results) built from Spark SQL / DataFrame / ML primitives.
"""

__version__ = "0.1.0"
