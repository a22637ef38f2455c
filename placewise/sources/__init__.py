"""Reading and landing posts."""
