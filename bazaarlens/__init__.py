"""Marketplace-listing analytics on Spark: captures in, one partitioned listings table and its reports out."""
