"""The analytical operators, one module per family."""
