"""Operators for training-data pipelines over text (problems 1 to 10 of TESTDATA.md)."""
