"""Column functions: text normalisation, tokens, predicates, report values."""
