"""cabwise — trip analytics and text classification as Spark DataFrame operators.

Subpackages: ``functions`` (column expressions), ``sources`` (readers,
writers, table bindings), ``operators`` (trips, joins, lexicon, tfidf,
classify, textclass), ``plans`` (plan inspection, broadcast bounds,
partitioning, lineage cuts) and ``streaming`` (incremental hourly profile).
"""

__version__ = "0.1.0"
