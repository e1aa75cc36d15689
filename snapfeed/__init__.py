"""snapfeed: snapshot-feed cleaning, dedup and upsert as Spark DataFrame operators."""

__version__ = "0.1.0"
