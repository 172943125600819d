"""Training-data operators: quality, language, near copies, leaks, mixing and sharding. Nothing else imports this package."""
