"""Reusable DataFrame operators.

spine       calendar spine + zero-filled per-day facts
arrays      first element, LATERAL unnest (explode_outer), fan-out weight, membership join
joins       dimension lookup, patient enrichment
history     first visit per patient (maintained or from history), new / returning flags
aggregates  conditional counts, two-step distinct counts, total rows
percent     percent of total, running percent with peer rows
ordering    distributed global row number, consecutive-run marking and collapsing
rollup      cashier subtotals over a fixed frame
lineage     lineage cut by a Parquet table in the checkpoint folder
"""
