"""korpuswerk: a Spark engine for parallel corpora (original and normalised spelling)."""
