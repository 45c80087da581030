"""Spark-native finance analytics: ledger, budget, receivables and reports."""
