"""operators of corpusloom."""
