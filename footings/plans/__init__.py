"""Document-to-rows jobs built from the operators."""
