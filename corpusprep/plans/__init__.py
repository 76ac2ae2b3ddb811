"""Composed jobs: the registered queries and end-to-end corpus plans."""
