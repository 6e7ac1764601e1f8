"""corpusmill: Spark-native operators that turn raw web text into training corpora.

Operators take and return DataFrames, scalar functions take and return
Columns; nothing here collects data of unbounded size to the driver.
"""

__version__ = "0.1.0"
