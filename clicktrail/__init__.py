"""Web-event analytics on Spark: sessions, funnels, sequences, rankings, returns."""

__version__ = "0.1.0"
