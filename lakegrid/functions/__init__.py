"""Column functions: bands, masks, grid arithmetic, times and names."""
