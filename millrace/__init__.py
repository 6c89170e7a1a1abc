"""millrace: tables to features, models and reports, as Spark jobs."""
