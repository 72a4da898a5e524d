"""featspark: wide per-client feature tables and weighted risk models on Spark.

Every operator builds a DataFrame plan (or a Spark ML model); nothing is
materialised on the driver except small fitted parameters (vocabularies,
one-row statistics) whose size is checked before collection.
"""

__version__ = "0.1.0"
