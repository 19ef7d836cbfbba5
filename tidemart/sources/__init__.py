"""Readers for landed files and reshaping of nested source documents."""
