"""Column functions: text cleaning, word lists, hashing, JSON answers."""
