"""quern: table, text, graph and stream analytics as plain Spark DataFrame jobs."""
