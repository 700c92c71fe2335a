"""Models, views and reports composed from the operators."""
