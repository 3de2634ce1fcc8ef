"""sentsift — document analytics and question retrieval on Spark.

Subpackages: ``functions`` (column expressions and fixed values), ``sources``
(tables, files, corpus build), ``operators`` (profiling, terms, cleaning,
sentences, vectors, retrieval, ranking, models), ``plans`` (registered queries
and their DuckDB oracle), ``streaming`` (question stream).
"""

__version__ = "0.1.0"
