"""Batch and streaming reports on when people share their location in posts."""
