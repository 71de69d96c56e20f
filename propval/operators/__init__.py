"""Analytics operators: DataFrame(s) -> DataFrame functions."""
