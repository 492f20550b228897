"""methylspark sources."""
