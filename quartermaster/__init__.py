"""quartermaster - supply-chain metrics on Spark.

Layout:

* ``sources``   - raw scans, the conformed star (built once, written to the
  checkpoint dir), seeded generators, catalog sink and data dictionary;
* ``functions`` - Column builders and trusted Spark SQL functions;
* ``operators`` - measures and ``star_metrics``, enrichment joins, analysis,
  dashboard, quality and evaluation operators;
* ``streaming`` - incremental refresh, daily counts, alerts, changing orders;
* ``llm``       - operators for training-data pipelines (nothing else imports it);
* ``plans``     - the named results, their DuckDB oracles and the registry
  behind ``__spark_entry__.queries()``.
"""

__version__ = "0.2.0"
