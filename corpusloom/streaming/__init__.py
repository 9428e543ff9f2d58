"""streaming of corpusloom."""
