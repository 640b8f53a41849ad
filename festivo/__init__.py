"""Retail event planning on Spark DataFrames.

From daily sales, product hierarchies, promotions, trading hours and a fiscal
calendar to daily targets per node, store cluster and day, and from those
targets to a per-store, per-product, per-week upload.
"""
