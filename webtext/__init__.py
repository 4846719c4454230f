"""webtext: web pages and log lines to searchable, model-ready tables, as Spark DataFrame jobs."""
