"""frameloom: DataFrame-native analytics for media datasets and run metrics."""

__version__ = "0.1.0"
