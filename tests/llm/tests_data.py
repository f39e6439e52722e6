import os

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards watch from a distant hill in silence"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
