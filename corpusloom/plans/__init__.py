"""plans of corpusloom."""
