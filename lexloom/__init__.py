"""lexloom: a Spark-first engine for lexical graphs, corpora and training text."""
