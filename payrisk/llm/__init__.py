"""Operators of a training-data pipeline over web documents, each a Spark job of its own."""
