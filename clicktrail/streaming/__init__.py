"""The same sessions on a stream of events."""
