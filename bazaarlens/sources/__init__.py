"""Inputs and the stored tables: captures, flattened pages, site dimension, listings store, run log."""
