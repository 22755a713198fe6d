"""playlog: listening-event analytics on Spark.

Validation with a dead-letter output, skip rate with flops, listen counts per country
and track enriched from a compacted catalog, royalties paid once per event, and
stream-farm alerts — each a DataFrame function that runs in batch and in Structured
Streaming.  Start with ``playlog.plans.batch.run`` or ``playlog.streaming.jobs.run``.
"""

__version__ = "0.1.0"
