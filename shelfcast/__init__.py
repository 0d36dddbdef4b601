"""shelfcast: a Spark-native retail CDC lakehouse and demand-forecast engine.

Change events flow bronze -> silver -> gold on Spark DataFrames; on top of
gold sit the dense demand panel, a seasonal-naive baseline with its error
metrics, demand-driver features and relational constraint checks.  Every
operator is a DataFrame -> DataFrame function built on Catalyst expressions.
"""

__version__ = "0.1.0"
