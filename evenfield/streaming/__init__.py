"""Statistics that new tiles are added to as they arrive."""
