"""Relational building blocks that keep working when one key holds a third of the rows."""
