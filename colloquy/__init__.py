"""Transcript analytics as composable Spark DataFrame operators."""
