"""The daily load as a file stream."""
