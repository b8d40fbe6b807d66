"""tabcast — Spark-native tabular regression analytics: profile, engineer, impute, encode,
split, train, tune and blend, with every pass over rows running as Spark work."""

__version__ = "0.1.0"
