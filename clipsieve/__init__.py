"""Clip-metadata selection engine on the PySpark DataFrame API."""
