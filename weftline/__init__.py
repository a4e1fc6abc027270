"""Corpus engineering on PySpark: DataFrame-to-DataFrame transforms that leave planning to Catalyst."""
