"""Operators: DataFrame in, DataFrame out; actions only where a scalar decides what comes next."""
