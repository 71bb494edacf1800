"""Training-data operators: one module for each, with its registered query and SQL."""
