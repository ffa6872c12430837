"""Writers of trajectory packages."""
