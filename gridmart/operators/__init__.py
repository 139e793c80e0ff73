"""DataFrame operators: keys, columns and constants are arguments."""
