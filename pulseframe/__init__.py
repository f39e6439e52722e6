"""Data-health, drift and alert monitoring of dated tables, written as Spark DataFrame plans."""
