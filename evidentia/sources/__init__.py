"""Readers and writers of tables, and links in web pages."""
