"""DataFrame -> DataFrame transformations, one module per layer."""
