"""Column functions: codecs, headers and file names."""
