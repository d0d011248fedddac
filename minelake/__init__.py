"""minelake: pattern mining and explainable classification on Spark DataFrames."""

__version__ = "0.1.0"
