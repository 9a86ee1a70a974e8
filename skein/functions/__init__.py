"""Column functions over text."""
