"""Footings: a public-finance evidence warehouse as PySpark DataFrame functions.

A *footing* is the proof that a column adds up to the total printed under it.
Every operator takes column names, returns a DataFrame or a Column, and leaves
the physical plan to Catalyst and AQE.
"""

__version__ = "0.1.0"
