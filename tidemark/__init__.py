"""tidemark: omnichannel retail analytics on Spark.

Layers follow the medallion layout: bronze (raw, declared schemas), silver
(typed, cleaned, deduplicated) and gold (business aggregates).  Every
operator is a ``DataFrame -> DataFrame`` function built from Spark's own
DataFrame / window primitives; no Python UDF runs in any hot path.
"""

__version__ = "0.1.0"
