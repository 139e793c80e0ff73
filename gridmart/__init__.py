"""Medallion analytics for energy and economic time series, written as Spark DataFrame operators."""
