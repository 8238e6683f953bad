"""Registered queries: each operator run over the given tables, with the same question in plain SQL where SQL can ask it."""
