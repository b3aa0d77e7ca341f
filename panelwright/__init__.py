"""Analytics on large panels of sales series, as DataFrame operators on Spark."""
