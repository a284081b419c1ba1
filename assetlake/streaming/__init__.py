"""Structured Streaming forms of the sensor operators; stateless parts are shared with the batch code."""
