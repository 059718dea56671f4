"""Whole-table operators for sequencing data on Spark."""
