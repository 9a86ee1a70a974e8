"""skein.sources."""
