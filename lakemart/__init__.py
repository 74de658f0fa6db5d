"""Retail-order analytics on PySpark: cleaning, marts, customer products, quality, upserts."""
