"""Genetic-variant text mining as Spark jobs."""
