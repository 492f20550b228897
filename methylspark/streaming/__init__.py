"""methylspark streaming."""
