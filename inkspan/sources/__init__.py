"""Readers: JSON files of several shapes, folders of texts and images, paginated listings."""
