"""The README coverage map names every registered query, and only those."""

import os
import re

from terrascore.plans.queries import all_queries

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_readme_names_every_registered_query():
    text = open(README, encoding="utf-8").read()
    coverage = text[text.index("## Coverage of SURVEY"):text.index("## Not built")]
    keys = set(all_queries())
    named = set(re.findall(r"`([a-z_]+)`", coverage))
    missing = {k for k in keys if k not in named}
    # view_* keys are listed as a group
    missing -= {k for k in missing if k.startswith("view_") and "`view_*`" in coverage}
    assert not missing, missing
    # every backticked name in a "Query key" column is a real key
    last_cells, in_keyed_table = set(), False
    for row in coverage.splitlines():
        if not row.startswith("|"):
            in_keyed_table = False
            continue
        if row.rstrip(" |").endswith("Query key"):
            in_keyed_table = True
            continue
        if in_keyed_table and not row.startswith("|---"):
            last_cells |= set(re.findall(r"`([a-z_]+)`", row.rstrip(" |").rsplit("|", 1)[-1]))
    unknown = {k for k in last_cells if k not in keys}
    assert not unknown, unknown
