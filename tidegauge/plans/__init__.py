"""End-user queries, the stand-in inputs and the registry of checked queries."""
