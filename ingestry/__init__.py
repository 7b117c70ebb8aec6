"""ingestry: Spark-native record ingestion and data-quality operators.

Every operator is a DataFrame -> DataFrame function (or a Column -> Column
expression) so Catalyst sees one declarative plan per job.
"""

__version__ = "0.1.0"
