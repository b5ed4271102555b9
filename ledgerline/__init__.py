"""ledgerline — Spark-native analytics for financial transactions.

Batch medallion ETL (ingest -> bronze -> silver -> fact upsert), rule-based
fraud scoring (batch and Structured Streaming), reporting views, data-quality
suites, audit and lineage tables.  Every operator is a pure
``DataFrame -> DataFrame`` function built from DataFrame / SQL expressions;
I/O only happens in the jobs under ``ledgerline.plans`` and
``ledgerline.streaming``.
"""

__version__ = "0.1.0"
