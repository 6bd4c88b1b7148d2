"""Order and price analytics on Spark: an order-items mart and a price mart."""
