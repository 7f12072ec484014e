"""Claims analytics on Spark: typed landings, star schema, review rules, cost and policy marts."""

__version__ = "0.1.0"
