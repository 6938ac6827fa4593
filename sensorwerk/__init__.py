"""sensorwerk: industrial telemetry analytics written as plain Spark DataFrame / SQL / Structured Streaming.

Layout
  sources/    readers: raw JSON logs, IoT file/Kafka streams, registry, staging, stand-in tables
  sinks/      partitioned Parquet lake writes, quarantine, load ordering, statistics
  functions/  reusable Column expressions (time buckets, ratios, SLA status)
  operators/  DataFrame -> DataFrame stages (quality, dedup, enrich, aggregates, dims, warehouse, alerts)
  plans/      composed reports and jobs
  streaming/  streaming twins of the batch stages
"""

__all__ = ["config", "schemas"]
