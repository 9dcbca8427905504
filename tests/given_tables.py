"""Folders of the given tables (an importable name of its own: every folder of tests may have a conftest)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
