"""strata: Spark-native SaaS product-event analytics.

Layers, all DataFrame -> DataFrame:

* ``strata.sources``    message / table / stage readers and the fixture view
* ``strata.functions``  column-level helpers (guarded rates, JSON count maps, ...)
* ``strata.operators``  bronze, silver, gold, KPI, star-schema, checks, merge
* ``strata.streaming``  Structured Streaming jobs (bronze, silver fan-out, health)
* ``strata.plans``      end-to-end batch jobs and the registered query catalog
"""

__version__ = "0.1.0"
