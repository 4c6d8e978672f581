"""Paths of the driver's tables that tests read."""

SMALL = "/root/testdata/sf0.001"
