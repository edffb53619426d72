"""Privacy-aware analytics on Spark: protection operators, contracts, verdicts and message streams."""
