"""DataFrame transformations, one module per subject."""
