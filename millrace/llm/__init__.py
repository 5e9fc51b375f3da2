"""Operators that turn raw text into training data. Nothing else in the library imports this package."""
