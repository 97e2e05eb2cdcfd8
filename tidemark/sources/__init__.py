"""Readers of exports, browser databases, lists, captions and documents."""
