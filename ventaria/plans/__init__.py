"""Named views and reports built from the operators."""
