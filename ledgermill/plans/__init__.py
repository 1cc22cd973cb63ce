"""Layer transformations, marts and the jobs that run them."""
