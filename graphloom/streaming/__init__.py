"""An extension: Markdown files as a stream."""
