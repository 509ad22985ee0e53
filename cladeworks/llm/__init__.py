"""Training-data operators over text, vector and media columns, each a Spark job."""
