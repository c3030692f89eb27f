"""Program-graph analytics and corpus preparation on Spark."""
