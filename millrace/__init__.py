"""millrace: relational, window, nested, sampling, graph, feature and streaming operators on PySpark."""
