"""Lontar: document analytics on Spark, as ``DataFrame -> DataFrame`` operators."""
