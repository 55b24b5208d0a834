"""Message streams between the frame stages."""
