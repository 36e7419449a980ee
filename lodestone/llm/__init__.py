"""Operators that turn crawled text into training data; nothing else in the library imports this subpackage."""
