"""Readers, writers and adapters that produce the tables the reports use."""
