"""tamarind: marketplace lakehouse analytics as plain PySpark.

Every operator takes DataFrames and returns DataFrames (or Columns); nothing
runs at import time and no operator creates a session of its own.
"""

__version__ = "0.1.0"
