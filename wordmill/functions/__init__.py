"""Column-level functions: analysis chains, stemmers, folding, hit formatting."""
