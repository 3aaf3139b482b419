"""Column expressions: text, matching, sentiment, labels and times."""
