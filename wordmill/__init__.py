"""wordmill: corpus term analysis and text-classification experiments on Spark DataFrames."""

__version__ = "0.1.0"
