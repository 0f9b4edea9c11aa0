"""Folioflow: article-stream, snapshot and corpus analytics expressed as Spark DataFrames."""
