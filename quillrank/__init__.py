"""Text-relevance operators on Spark: retrieval, features, labels, ranking, metrics."""
