"""Reusable query shapes: ordered positions, running totals, exact quantiles, splits."""
