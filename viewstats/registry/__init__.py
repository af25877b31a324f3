"""The queries of ``__spark_entry__``: adapters over the given tables, Spark forms, SQL forms."""
