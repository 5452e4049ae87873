"""Operators: plain DataFrame -> DataFrame functions on built-in Spark expressions."""
