"""Part of kindred."""
