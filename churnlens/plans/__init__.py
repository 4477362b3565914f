"""Composite plans: the production build, the ELT job, the query catalogue."""
