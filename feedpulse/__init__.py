"""Product analytics for a news feed and a messenger, as Spark DataFrame jobs."""
