"""seqtally: barcode counting for pooled-screen sequencing data on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` transformation built from
Spark SQL expressions, joins and aggregations.  See README.md for the map from
operators to modules.
"""

from seqtally.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
