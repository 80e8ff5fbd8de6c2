"""Published statistical files into clean tables, as Spark jobs."""
