"""YAML alias files are read in time that grows with their lines."""

import time

from loomcast.sources import readers


def test_many_names_in_a_file(spark, tmp_path):
    lines = ["# marks", "- stray"]
    for i in range(20000):
        lines += [f"s{i}:" + " " * (i % 3), "  - 'A'", "", '- "R x"', f"not: a name {i}", "  # - no"]
    (tmp_path / "n.yaml").write_text("\n".join(lines))
    start = time.monotonic()
    got = [(r.alias, r.name) for r in readers.aliases(spark, f"{tmp_path}/n.yaml").collect()]
    assert time.monotonic() - start < 20
    want = [("stray", None)] + [(a, f"s{i}") for i in range(20000) for a in ("A", "R x")]
    assert sorted(got, key=str) == sorted(want, key=str)
