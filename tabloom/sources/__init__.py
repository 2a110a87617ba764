"""Reading and writing: delimited files, paths, catalog tables, fitted models."""
