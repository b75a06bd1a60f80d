"""difframe: a PySpark-native engine for powder-diffraction catalogues.

Everything is a function from DataFrames to DataFrames.  The subpackage ``llm`` (training-data
operators) is optional: nothing else in the package imports it.
"""

__version__ = "0.1.0"
