"""Column builders shared by every stage."""
