"""shoplens: real-time commerce analytics written as Spark DataFrame / Structured Streaming jobs.

Layout
------
- ``sources``   readers: test tables, staging of domain streams, JSON ingest, Kafka / file streams
- ``functions`` column expressions (dates, masks, ages, ids, text match) — no UDFs
- ``operators`` the analytics: DAU, GMV, coupon alerts, order/detail joins, user dimension,
                dashboards, routing, keyed documents
- ``sinks``     table / document / topic writers and their read-side "latest per key" views
- ``streaming`` the same operators wired to ``readStream`` / ``writeStream``
- ``plans``     registered queries (Spark) and their DuckDB oracle SQL
"""

__all__ = ["session"]
