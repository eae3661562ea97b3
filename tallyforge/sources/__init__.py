"""Readers with declared schemas, binary formats, message sources and sinks."""
