"""Loan tables derived from the order tables, in Spark and in the oracle's SQL."""
