"""Operators: DataFrame -> DataFrame transforms (bars, features, risk, ...)."""
