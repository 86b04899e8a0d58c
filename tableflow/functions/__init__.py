"""Column functions: masks, canonical text, value comparison."""
