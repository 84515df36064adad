"""stockledger — a retail sales and inventory mart written as Spark DataFrame jobs.

Layers follow the mart: raw tables -> intermediate (customer history, daily
sales) -> analytics (customer dimension, weekly sales x inventory fact).
Every operator is a function ``DataFrame -> DataFrame`` that Spark plans and
distributes; jobs in :mod:`stockledger.plans` add reads, writes, run dates and
watermarks so any scheduler can call them.
"""

from stockledger.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
