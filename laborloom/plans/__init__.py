"""The two pipelines and the queries that decode their output."""
