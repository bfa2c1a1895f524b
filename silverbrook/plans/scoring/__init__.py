"""Model training and scoring as Spark jobs."""
