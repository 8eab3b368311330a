"""Offline campaign recommendation and its measurement, as Spark DataFrame operators."""
