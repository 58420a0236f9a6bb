"""Table and script sources, staging, target schemas."""
