"""tidemark: a Spark library for large event archives.

Raw hourly archives -> typed lake table -> serving copies -> mergeable rollups
-> parameterised reads, in batch and with Structured Streaming.

All event times are TIMESTAMP_NTZ holding UTC wall-clock time. Parquet stores
that type as 64-bit integers with min/max statistics, so time filters reach the
row groups; the default encoding of TIMESTAMP has no usable statistics.
"""
