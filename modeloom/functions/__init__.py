"""Column builders: array helpers, repeatable draws, mixture posteriors."""
