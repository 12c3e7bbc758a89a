"""Millrace: reusable, column-parameterised data preparation and analytics on PySpark.

Every operator takes and returns DataFrames.  Anything that is learned from the
data (bounds, indices, means, weights) is fitted first and applied afterwards, so
the same fitted state serves training data, new data and streams.
"""

__version__ = "0.1.0"
