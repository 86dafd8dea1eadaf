"""cellcast: a Spark-native library for gap-checked cell-by-day panels, past-only
features, next-day labels, exact ranking metrics and within-day risk publishing."""

__version__ = "0.1.0"
