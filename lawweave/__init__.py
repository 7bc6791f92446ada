"""lawweave: a Spark-first engine for corpora of regulations.

Every operator is a function from DataFrame(s) to a DataFrame; Catalyst plans
the work.  Sub-packages: ``functions`` (column expressions), ``operators``
(relational operators), ``sources`` (scans and sinks), ``streaming``
(incremental ingestion), ``plans`` (the registered queries and their SQL).
"""

__version__ = "0.1.0"
