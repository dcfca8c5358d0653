"""monthend: monthly business metrics on Spark.

Raw event tables and mention files become a long fact table
``(fecha, metrica, valor)``; the fact table is kept current with month
reloads and upserts; a comparison table adds fiscal-year-to-date totals,
same-month-last-year values and previous-fiscal-year values.

Everything is expressed with DataFrame operators and built-in functions so
that Catalyst plans it and the same code runs on a laptop or a cluster.
"""

from monthend.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
