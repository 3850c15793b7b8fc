"""tessera: a PySpark library for preparing text corpora for retrieval and measuring retrieval quality.

Every operator is a DataFrame -> DataFrame function (or a Column builder) whose
core runs as a Spark plan.
"""

__version__ = "0.1.0"
