"""Table synchronisation and reconciliation on Spark, and operators for training data."""
