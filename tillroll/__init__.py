"""tillroll: retail customer analytics as composable Spark DataFrame operators.

Layers:

* ``tillroll.sources``   – entity readers (catalog, parquet, CSV) and sinks
  (file write, external-table publish, audit append).
* ``tillroll.functions`` – column expressions shared by operators
  (trailing windows, conditional counts, percent change, e-mail shape).
* ``tillroll.operators`` – ``DataFrame -> DataFrame`` analytics: cleaning,
  quality gate, churn, fraud, ranking, omni-channel engagement, sales trends.
* ``tillroll.plans``     – jobs that wire operators to sources and sinks
  (one pass per output, Observation metrics, audit), and the query registry.
* ``tillroll.llm``       – operators for training data, apart from all others.
* ``tillroll.testdata``  – the generated tables as the entities.

Every operator takes an explicit ``as_of`` date instead of ``current_date()``
and never triggers an action; the caller decides when to execute.
"""

from tillroll.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
