"""Column-level functions: analysis and scoring."""
