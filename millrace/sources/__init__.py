"""Scans: recorded feed, sitemap, JSON and HTML responses become rows."""
