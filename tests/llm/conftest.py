import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import helpers  # noqa: E402


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Odd rows of every kind, and columns whose names clash with the operators' own."""
    docs, benchmark = helpers.corpus()
    pages = [(1, "http://A.Example.COM/en/1?x=1#f", "h"), (2, "https://www.example.com/en/2", "h"), (3, "http://x.net/es/1", "h"), (4, None, None),
             (5, "no scheme", "h"), (6, "", "h"), (None, "http://b.org/q?z=1&y=2", "h"), (6, "", "h"), (7, "http://com?a/", "h"),
             (8, "http://q.com", "h"), (9, "http://notcom/", "h"), (10, "x://" + "y" * 5000 + ".com/" + "9" * 5000, "h")]
    pages += [(100 + i, f"http://s{i % 7}.{('com', 'net', 'org')[i % 3]}/{('en', 'es', 'fr')[i % 3]}/{i}", "h") for i in range(90)]
    said = [(1, 0, "user", "hi <s>[INST] & &lt; </s>"), (1, 1, "assistant", "ok\nyes"), (2, 0, "assistant", None), (3, 5, "user", "x"),
            (3, 5, "assistant", "tie"), (3, 9, "assistant", ""), (3, 9, "assistant", ""), (None, 0, None, "n"), (None, None, "assistant", "z" * 50000)]
    said += [(4, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(70)]
    return helpers.save(spark, tmp_path_factory.mktemp("odd"), docs, benchmark, pages, said, clash=True)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    return helpers.save(spark, tmp_path_factory.mktemp("nothing"), [])
