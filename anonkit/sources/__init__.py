"""Reading and writing tables, and deriving the order table."""
