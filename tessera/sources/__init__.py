"""Readers of label text, label JSON, images and file listings."""
