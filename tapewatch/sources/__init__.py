"""Readers, writers, the fixture projection and the event simulator."""
