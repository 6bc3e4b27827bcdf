"""Column-level helpers: money, text and dates."""
