"""Column -> Column building blocks: tokens, n-grams, metrics, vectors."""
