"""brasa: a Spark-native warehouse for operational HR and fleet data.

Layers (all lazy DataFrame functions):

* ``sources``   - table readers, bronze-shaped inputs, sinks, freshness
* ``functions`` - column helpers (text cleaning, safe casts, keys, ratios)
* ``operators`` - as-of join, interval expansion, SCD2, upsert, ranking,
                  data-quality checks, metrics
* ``plans``     - the named models: staging, dimensions, facts, analytics
* ``streaming`` - micro-batch form of the incremental fact load
"""

__version__ = "0.1.0"
