"""Plans of the lexical engine."""
