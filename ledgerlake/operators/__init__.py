"""DataFrame-to-DataFrame jobs: features, quality, Gold, dimensions, privacy, models, operations."""
