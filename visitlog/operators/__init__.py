"""Generic operators over any frame, by column name."""
