"""omicspark: Spark jobs for sequencing, expression and annotation tables."""
