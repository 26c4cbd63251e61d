"""Column functions and small planning functions of array metadata."""
