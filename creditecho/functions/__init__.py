"""Column expressions: numeric guards, text cleaning, vectors and label values."""
