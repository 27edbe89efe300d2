"""Readers and writers for stored pages, crawl results, snapshots and the notice table."""
