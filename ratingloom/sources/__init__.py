"""Readers: delimited text, messages, HTML pages, stored outputs and streams."""
