"""Column functions: text primitives, gates, the wrapper strip and label parsing."""
