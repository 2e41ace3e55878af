"""Part of labeldiff."""
