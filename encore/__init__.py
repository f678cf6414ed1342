"""encore: listening-log analytics and recommendation on Spark DataFrames.

Subpackages:

* ``encore.sources``   - Parquet loaders and sinks, fixture tables
* ``encore.functions`` - shared column expressions
* ``encore.operators`` - preparation, splits, statistics, popularity,
  ranking metrics, id indexing, latent-factor models
* ``encore.plans``     - the query catalogue with SQL twins, jobs, comparison
* ``encore.streaming`` - empty: the method has no streaming part
"""

__version__ = "0.1.0"
