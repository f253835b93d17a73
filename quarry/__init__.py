"""quarry: Spark-native operators for event analytics, streaming summaries,
fraud rules, statistics, feature engineering, trust-graph features and MLlib jobs.

Every operator takes DataFrames and returns a DataFrame; nothing collects rows
except where a docstring says so (small, bounded fetches only).
"""

__version__ = "0.1.0"
