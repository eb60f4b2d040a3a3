"""Operators that turn raw text tables into training data."""
