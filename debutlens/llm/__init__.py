"""Training-data operators on Spark: one module per operator, `queries` for the registered queries."""
