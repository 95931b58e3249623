"""Entry points, and the queries over the driver's tables."""
