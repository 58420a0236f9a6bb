"""Business jobs.  Every function takes the source tables as a mapping from name to DataFrame."""
