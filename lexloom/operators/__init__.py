"""Operators on DataFrames: tokens, affix expansion, filtering, word forms, assembly, reports."""
