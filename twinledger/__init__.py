"""Keep two copies of a message archive in agreement, as Spark DataFrame plans.

Left copy: a document index (free text plus key and times).
Right copy: a lake table partitioned by reporting entity and quadrimester.
"""

from twinledger.session import configure

__all__ = ["configure"]
