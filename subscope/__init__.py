"""Customer-usage analytics as Spark jobs: cleaning, features, profiles, streams and models."""
