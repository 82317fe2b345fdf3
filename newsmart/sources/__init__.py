"""Readers: raw JSON, slim JSON lines, file listings and article views of other tables."""
