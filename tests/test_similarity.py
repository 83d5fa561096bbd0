import pytest
from pyspark.sql import functions as F

from leadpipe.functions import similarity as sim


def test_ratios_by_example():
    assert sim.ratio("abcd", "abcd") == 100
    assert sim.ratio("abcd", "bcde") == 75
    assert sim.ratio("", "") == 0
    assert sim.token_sort_ratio("new york mets", "mets york new!") == 100
    assert sim.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert sim.token_sort_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") < 100
    assert sim.partial_ratio("york", "new york mets") == 100
    assert sim.weighted_ratio("new york mets", "new YORK mets") == 100
    assert sim.weighted_ratio("york", "new york mets") == 90
    assert sim.weighted_ratio("a", "a " + "b" * 40) == 60
    assert sim.token_set_ratio("!!", "abc") == 0


@pytest.mark.parametrize("mode", list(sim.MODES))
def test_best_candidate(frame, mode):
    df = frame(
        [
            (1, "acme", ["http://www.other.org", "http://www.acme.com", "http://www.acme.com"]),
            (2, "acme", []),
            (3, None, ["x"]),
            (4, "acme", None),
            (5, "acme", ["zzz", "yyy"]),
            (6, "acme", [None, "acme"]),
        ],
        "n int, name string, links array<string>",
    )
    rows = df.select("n", sim.best_candidate(F.col("name"), F.col("links"), mode).alias("b"))
    found = {r.n: (r.b.link, r.b.score) if r.b else (None, None) for r in rows.collect()}
    assert found[1][0] == "http://www.acme.com"
    assert found[2] == found[3] == found[4] == (None, None)
    assert found[5] == ("zzz", 0)
    assert found[6] == ("acme", 100)


def test_same_as_scoring_every_pair(spark):
    """Brute force over the links of small pages."""
    names = ["acme", "globex", "initech 9"]
    links = [f"http://www.{n.replace(' ', '')}{i}.com/" for n in names for i in range(4)]
    df = spark.createDataFrame([(n, links) for n in names], "name string, links array<string>")
    for mode, compare in sim.MODES.items():
        rows = df.select("name", sim.best_candidate(F.col("name"), F.col("links"), mode).alias("b"))
        for r in rows.collect():
            scores = [compare(link, r.name) for link in links]
            assert r.b.score == max(scores)
            assert r.b.link == links[scores.index(max(scores))]
