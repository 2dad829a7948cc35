"""tessera."""
