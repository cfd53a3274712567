"""Lexical analytics over multilingual text tables, expressed as Spark DataFrame operators."""

__version__ = "0.1.0"
