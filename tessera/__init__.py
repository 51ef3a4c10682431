"""A resource query engine on PySpark: declared resources, immutable queries, mutations."""
