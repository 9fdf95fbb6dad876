"""The warehouse: models and their graph, data tests, reports."""
