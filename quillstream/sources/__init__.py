"""Readers and writers: files, message queue, result tables, saved models."""
