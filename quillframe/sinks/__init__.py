"""Writers: files and catalog tables."""
