"""Writers: CSV and text outputs, keyed messages, keyed cells."""
