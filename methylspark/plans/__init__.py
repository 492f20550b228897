"""methylspark plans."""
