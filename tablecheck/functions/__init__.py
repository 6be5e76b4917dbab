"""Column expressions: predicates, text, figures, masks, encryption."""
