"""DataFrame -> DataFrame building blocks; all usable with ``df.transform``."""
