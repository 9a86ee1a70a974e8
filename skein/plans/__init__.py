"""skein.plans."""
