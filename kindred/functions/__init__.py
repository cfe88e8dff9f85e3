"""Column functions: cleaning, texts and vectors."""
