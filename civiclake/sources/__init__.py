"""Readers and writers of the landing, clean and analytics layers."""
