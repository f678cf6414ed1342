"""Operators from DataFrame to DataFrame. Those that write a table or fit a model say so."""
