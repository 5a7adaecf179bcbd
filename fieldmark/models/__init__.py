"""Training, scoring and keeping models, all with Spark ML."""
