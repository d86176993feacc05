"""Named reports composed from the operators."""
