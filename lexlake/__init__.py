"""lexlake: a Spark-native engine for legal and commercial records.

Raw feeds are landed with lineage, validated against typed contracts, checked by
declarative quality suites, merged by key or kept as dated history, and rolled up
into reports. Every step takes and returns DataFrames.
"""
