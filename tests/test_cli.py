"""Command line: list and argument errors (running a query is covered by
the oracle tests through the same registry)."""

from deskpulse.__main__ import main
from deskpulse.plans.registry import QUERIES


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert [line.split()[0] for line in out] == list(QUERIES)


def test_unknown_query(capsys):
    assert main(["run", "no_such_query", "--inputs", "/nonexistent"]) == 2
    assert "unknown query" in capsys.readouterr().err
