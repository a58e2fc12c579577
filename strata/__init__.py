"""strata: a medallion pipeline for JSON event envelopes, written as plain
PySpark DataFrame and Structured Streaming operators.

Layers: a transport topic (Kafka-shaped records) is parsed and validated
into a Bronze accepted table and a Bronze quarantine table; Silver keeps one
typed row per idempotency key; Gold keeps the current row per business key.
Serving, publishing, reconciliation and daily quota ledgers read from those
tables.  Every public operator is ``DataFrame -> DataFrame`` and can be used
with ``DataFrame.transform``; none holds a module-level session.
"""

__version__ = "0.1.0"
