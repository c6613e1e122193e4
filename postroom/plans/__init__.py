"""Jobs over a whole archive, and one query per operator on the given tables."""
