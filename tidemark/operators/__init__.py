"""Operators: DataFrame in, DataFrame out. None of them starts a job."""
