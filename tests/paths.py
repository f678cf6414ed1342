"""Folders the tests use, in a module whose name no conftest file shares."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
