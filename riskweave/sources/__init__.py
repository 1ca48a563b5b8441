"""Declared schemas (``schemas``) and readers / writers (``io``)."""
