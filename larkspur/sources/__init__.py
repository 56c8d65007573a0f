"""Tables from files."""
