"""Readers of bounded inputs and sinks that publish whole outputs only."""
