"""shelfguard — a retail stock-out mart built as plain Spark DataFrame jobs.

Layers: landed CSV feeds are appended to bronze tables by Structured
Streaming, silver keeps the latest version of every observation and conforms
it into dimensions and facts, gold joins them into a daily store-product
stock-out mart, and serving queries aggregate the mart.
"""

__all__ = ["config", "schemas", "session"]
