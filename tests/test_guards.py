"""Static guards on the library: rules the design relies on."""
from __future__ import annotations

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "tickgate"

FORBIDDEN = {
    r"\blocalCheckpoint\b": "lineage cuts must survive executor loss (use cut_lineage)",
    r"\bcrossJoin\b": "no cartesian products",
    r"@F\.udf|F\.udf\(|\budf\(": "no row-at-a-time Python UDFs",
    r"\.rdd\b": "DataFrame API only",
    r"\.toPandas\(": "no driver-side materialisation of data",
}


def test_library_respects_design_rules():
    hits = []
    for path in LIB.rglob("*.py"):
        text = path.read_text()
        for pat, why in FORBIDDEN.items():
            for m in re.finditer(pat, text):
                line = text[: m.start()].count("\n") + 1
                hits.append(f"{path.relative_to(LIB)}:{line}: {why}")
    assert hits == []


def test_no_collect_in_operators():
    for path in (LIB / "operators").rglob("*.py"):
        assert ".collect()" not in path.read_text(), path
