"""Sinks: partitioned Parquet, published tables with a key contract, JDBC."""

from fleetsight.sinks.publish import jdbc_append, publish, publish_all, write_partitioned

__all__ = ["jdbc_append", "publish", "publish_all", "write_partitioned"]
