"""clinicflow: out-patient visit reports as Spark DataFrame plans.

Layout
------
sources/    logical tables (real parquet layout or stand-ins), range scans, sinks
functions/  column expressions (dates, Thai/Buddhist-era formats, categories, JSON)
operators/  reusable DataFrame operators (spine, array fan-out, new/old history,
            conditional pivots, totals, percents, distributed row numbers, runs)
plans/      the nine reports, each returning ``Report(meta, content)``
"""

from clinicflow.plans.base import Report
from clinicflow.sources.tables import Tables

__all__ = ["Report", "Tables"]
