"""Topic, landing and object sources."""
