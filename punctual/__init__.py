"""punctual: late-delivery analytics on Spark.

Order-item records become a star schema, an order-grain table and, from there,
diagnostics, statistical tests, classifiers and shipping-mode allocations.
Every operator takes DataFrames and returns a DataFrame.
"""
