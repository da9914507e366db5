"""Semantic text analytics on Spark: clean, embed, cluster, search, and reuse answers."""
