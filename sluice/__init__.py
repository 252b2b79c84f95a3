"""sluice: governed sales-data ingestion, canonicalisation and quality checks
expressed as Spark DataFrame operators.

Every public operator takes and returns DataFrames (or builds ``Column``
expressions); nothing is collected to the driver.
"""

__version__ = "0.1.0"
