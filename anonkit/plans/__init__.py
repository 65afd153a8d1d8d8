"""Purpose-limited views, the questions asked of them, and the registry of all queries."""
