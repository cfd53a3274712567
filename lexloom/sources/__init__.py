"""Readers and writers of glossaries, corpora, dictionaries, audits and reports."""
