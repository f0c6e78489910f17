"""DataFrame-to-DataFrame steps; all of them are lazy."""
