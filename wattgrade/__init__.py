"""Analytics for graded assets (dwellings with an energy label) as Spark DataFrame operators."""
