"""DataFrame-to-DataFrame operators on canonical events."""
