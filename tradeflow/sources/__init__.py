"""Reading the three feeds from files, and writing them for loading."""
