"""Where events go: batch-partitioned tables, compacted versions, topics."""
