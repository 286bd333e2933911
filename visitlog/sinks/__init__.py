"""Distributed writers."""
