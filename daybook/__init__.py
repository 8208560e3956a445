"""Daily retail figures from order, order-item and product files, on Spark."""
