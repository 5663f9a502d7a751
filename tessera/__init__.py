"""tessera: change-data analytics on Spark.

Change records from one wide key-value table are decoded, landed as raw JSON
(bronze), cleaned into Parquet (silver) and aggregated into serving tables
(gold). Everything is a DataFrame plan; the only Python on the hot path is the
per-task state function of the streaming status machine.
"""

__version__ = "0.1.0"
