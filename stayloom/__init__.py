"""Hospital-encounter analytics as Spark jobs: rules, cleaning, features, star schema, marts, measures, models."""
