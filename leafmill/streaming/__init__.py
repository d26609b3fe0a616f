"""The same reads on streams of arriving pages and requests."""
