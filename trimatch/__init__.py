"""trimatch: three-way order / delivery / invoice reconciliation on Spark.

Everything is expressed with the DataFrame API so Catalyst and AQE plan the
work; no Python runs per row.  Entry points:

* :mod:`trimatch.sources`   - readers: INSERT dumps, monthly invoice files,
  staged legs, and legs derived from the benchmark tables.
* :mod:`trimatch.operators` - filters, repair, aggregation, joins,
  classification, data-quality checks, column resolution.
* :mod:`trimatch.plans`     - ``SourceSpec`` profiles (OMS, DMS) and the lazy
  ``reconcile`` pipeline, summaries, ledgers and report writers.
* :mod:`trimatch.streaming` - incremental staging of monthly invoice drops.
"""

from trimatch.plans.spec import DMS, OMS, SourceSpec
from trimatch.plans.reconcile import reconcile

__all__ = ["DMS", "OMS", "SourceSpec", "reconcile"]
