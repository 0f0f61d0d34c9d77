"""cartwheel: order-stream analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function over the order-event
schema (``cartwheel.schemas.ORDER_EVENT``), so the same code serves batch
tables and Structured Streaming.
"""

from cartwheel.config import JobConfig

__all__ = ["JobConfig"]
