"""Independent SQL statements of every checkable query, in plain (naive) form."""
