"""The registered queries: each job of the library run over the given tables."""
