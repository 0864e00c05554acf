"""The four classifiers, their grids, and the search over them."""
