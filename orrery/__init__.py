"""orrery: a Spark-native star catalog engine with operators for training-data corpora."""
