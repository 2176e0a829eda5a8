"""Message streams."""
