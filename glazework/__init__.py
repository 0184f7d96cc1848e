"""glazework: a Spark-native repairs warehouse.

One dirty, flat table of glass-repair jobs is cleaned into a staging table,
published as seven dimensions and one fact table, and checked by data-quality
queries that return the offending rows. Every step is a DataFrame job; the
cleaning rules are built-in Column expressions (no Python UDFs).

Layout:
  functions/  Column expressions (text, dates, numbers, keys)
  sources/    raw table schema and readers, mapping seeds
  operators/  lookups, mapping joins, dedupe, dimension build, date spine, quality
  plans/      staging, marts and the whole build; the named query registry
"""

__version__ = "0.1.0"
