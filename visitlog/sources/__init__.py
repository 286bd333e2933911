"""Readers, landing of raw data, and frames derived from other tables."""
