"""DataFrame to DataFrame steps shared by batch and streaming."""
