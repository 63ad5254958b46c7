"""gearbox: prepare, encode and model wide tabular data with Spark.

Every public function takes DataFrames (and a SparkSession where it must
create one) and returns DataFrames; no function owns or stops a session.
Sub-packages:

* ``sources``   - typed Parquet/CSV readers, path guards, derived fixtures
* ``sinks``     - Parquet/CSV writers (directory, partitioned, bounded single file)
* ``functions`` - reusable Column expressions (missing-value tests, keyed hashes)
* ``operators`` - cleaning, layout/splitting, ordering, statistics, features,
                  metrics and MLlib model operators
* ``plans``     - end-to-end jobs composed from the operators, and the query registry
* ``streaming`` - incremental (Structured Streaming) form of the per-part clean job
"""

__version__ = "0.1.0"
