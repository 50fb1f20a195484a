"""Operators: DataFrame -> DataFrame functions."""
