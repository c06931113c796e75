"""trailfeat: trajectory feature analytics on Spark."""
