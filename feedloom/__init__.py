"""feedloom: feed digests, source health and fallbacks as Spark DataFrame jobs."""
