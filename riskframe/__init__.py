"""riskframe: Spark-native credit-risk data validation, drift, metrics and model evaluation."""
__version__ = "0.1.0"
