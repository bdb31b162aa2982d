"""Operators that prepare text for model training; nothing else in the package imports them."""
