"""Readers and writers for the lake layers."""
