"""Reading and writing tables. Functions here only move data; they do not change it."""
