"""gridlake: power-market analytics as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) and column names and returns
DataFrames (or Columns); nothing in the package holds data on the driver.
"""

__version__ = "0.1.0"
