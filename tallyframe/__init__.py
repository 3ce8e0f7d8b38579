"""tallyframe: record, log, ledger and corpus analytics as plain Spark DataFrame jobs.

Every public function takes and returns ``pyspark.sql.DataFrame`` or ``Column``
objects; nothing is collected to the driver except bounded metadata (quantile
split points, observed metrics, one-row error probes in strict mode).
"""

__version__ = "0.1.0"
