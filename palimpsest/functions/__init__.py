"""Column expressions and the pure Python cores behind the Arrow functions."""
