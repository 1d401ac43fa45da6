"""trackwise."""
