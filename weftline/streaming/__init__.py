"""Message decoding and running entity counts."""
