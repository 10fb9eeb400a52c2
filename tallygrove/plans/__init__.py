"""Job specifications and the end-to-end jobs composed from the operators."""
