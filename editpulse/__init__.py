"""Map-editing activity analytics as DataFrame-to-DataFrame functions on Spark."""
