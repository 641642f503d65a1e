"""Text operators for training-data pipelines; optional part of the library."""
