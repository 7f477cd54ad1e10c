"""Lithos: literature mining and corpus curation as Spark DataFrame operators."""
