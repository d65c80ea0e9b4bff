"""Change-data-capture analytics on Spark: parse change streams, watch them, and report on tables."""
