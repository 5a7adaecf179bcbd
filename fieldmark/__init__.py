"""Predictive-analytics building blocks on Spark DataFrames.

Every operator is a plain function from DataFrame to DataFrame with the
columns given as arguments.  Nothing here keeps a session of its own or reads
the clock: times come in as arguments, so a run can be repeated.
"""

__version__ = "0.1.0"
