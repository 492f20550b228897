"""methylspark functions."""
