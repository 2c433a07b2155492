"""pavilion: match documents to star schema to reports, as plain Spark jobs."""
