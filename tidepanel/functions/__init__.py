"""Column helpers and scalar expressions."""
