"""The eleven queries."""
