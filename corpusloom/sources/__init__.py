"""sources of corpusloom."""
