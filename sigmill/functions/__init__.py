"""Column functions and the wire codec."""
