"""Governed reconciliation and geo-analytics operators for PySpark.

Every operator takes DataFrames and plain parameters and returns a lazy
DataFrame; Catalyst and AQE choose the physical plan.
"""
