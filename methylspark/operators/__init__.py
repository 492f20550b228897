"""methylspark operators."""
