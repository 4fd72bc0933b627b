"""The engine's queries by name, over the driver's tables."""
