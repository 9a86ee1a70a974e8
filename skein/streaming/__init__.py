"""skein.streaming."""
