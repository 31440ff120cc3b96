"""Column expressions: text cleaning, strict casts, timestamp parsing."""
