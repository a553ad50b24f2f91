"""Loads that go on: new files of a folder are loaded as they arrive."""
