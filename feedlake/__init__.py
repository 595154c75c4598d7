"""feedlake: social and news feed analytics on Spark."""
