"""Operators for preparing a text corpus; nothing outside this subpackage imports it."""
