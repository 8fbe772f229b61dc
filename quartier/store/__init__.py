"""Written point tables: committed batches, published partitions, queries."""

from .tables import Store
from .publish import publish, retire, vacuum
from .query import store_last, store_query

__all__ = ["Store", "publish", "retire", "vacuum", "store_query", "store_last"]
