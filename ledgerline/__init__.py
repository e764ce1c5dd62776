"""ledgerline: a Spark-native change-ledger and data-processing engine."""
