"""Readers of the formats that filings come in, and sinks."""
