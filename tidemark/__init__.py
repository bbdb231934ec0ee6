"""tidemark: a PySpark-native daily market and news feature engine.

Every stage is a pure ``DataFrame -> DataFrame`` function; only the jobs in
``tidemark.plans.jobs`` and the sinks in ``tidemark.sources`` write.
"""

__all__ = ["session", "config", "schemas"]
