"""Lexicon and tag-graph analytics on Spark DataFrames."""
