"""Named models of the warehouse, one DataFrame function each."""
