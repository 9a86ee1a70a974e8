"""skein.operators."""
