"""DataFrame operators; each works unchanged on batch and streaming input."""
