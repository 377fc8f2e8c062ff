"""Column expressions: the event contract, time buckets, JSON encoding, argument checks."""
