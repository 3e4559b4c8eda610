"""Scans, file discovery, listings, and format round trips."""
