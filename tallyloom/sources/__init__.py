"""Where data comes from."""
