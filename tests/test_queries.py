"""Registered queries against their SQL twins on the smallest data.

A selection runs by default; LANDLOOM_ALL=1 runs every query.
"""

import os
import sys

import pytest

from landloom.checks import registry
from tools.compare import compare, duck

registry.load()
SF = "/root/testdata/sf0.001"
FAST = """h01 h03 h07 h09 h10 h11 h13 v08 s06 j01 j03 j10 j12 j15 j19 j23 q01 q04 q09 w03 w04 a02 a05 a08 u02 u04 x02 x03 x12
g01 g02 g06 g08_symbols g10_dissolve_edges g20 g22_intersection f01 f03 f04 f13_split m03 m06 m08 m13 s01 s02_typed s03 s05 s11 s14 t01 t02 v09""".split()
NAMES = [n for n in registry.QUERIES if os.environ.get("LANDLOOM_ALL") or any(n.startswith(p) for p in FAST)]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, message = compare(spark, con, name, SF)
    assert ok, message
