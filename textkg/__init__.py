"""textkg: text-to-knowledge-graph analytics as Spark DataFrames."""
