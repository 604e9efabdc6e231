"""Risk scoring of event and transaction tables on Spark."""
