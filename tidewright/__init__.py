"""tidewright: a Spark-native engine for software-supply-chain scoring tables."""
