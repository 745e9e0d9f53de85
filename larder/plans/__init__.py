"""The survey's processing chains, composed of operators with stage boundaries between them."""
