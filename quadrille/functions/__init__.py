"""Column functions: geometry, grid cells, WKB and text."""
