"""sparkmart: retail marts, quality gates, features and statistics as Spark jobs."""
