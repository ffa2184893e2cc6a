"""Reading, writing and listing files, and the manifest of their states."""
