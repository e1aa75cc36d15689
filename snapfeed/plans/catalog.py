"""Imports every query module so the registry is complete."""

from snapfeed.plans import queries, oracle  # noqa: F401
from snapfeed.plans import clean_queries, doc_queries, feed_queries, io_queries, load_queries, payload_queries  # noqa: F401
from snapfeed.plans.registry import ORACLE, REGISTRY  # noqa: F401
from snapfeed.plans.queries import rx_flagship  # noqa: F401
