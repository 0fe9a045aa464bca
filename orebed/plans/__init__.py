"""End-to-end jobs: files in, operators, files out."""
