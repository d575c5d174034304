"""The smallest test tables."""

SMALL_SF = "/root/testdata/sf0.001"
