"""The scoring expressions against a plain statement of the rule."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from leadpipe.functions import titles as t
from leadpipe.operators import scoring as s
from workload.data import DOC_SHEETS, SHEETS, dims


class Rule:
    """The scoring rule in plain Python."""

    def __init__(self, sheets):
        rows = {name: rows for name, (_, rows) in sheets.items()}
        self.matrix, self.targets = {}, []
        for _, title, level, points in sorted(rows["title_matrix"]):
            self.matrix[level, title] = points
            if title not in self.targets:
                self.targets.append(title)
        self.level_map = {actual: sfdc for _, actual, sfdc in sorted(rows["level_mapping"])}
        self.levels = sorted(self.level_map, key=len, reverse=True)
        self.keyword_points = {k: points for _, k, points in sorted(rows["keywords"])}
        self.keywords = sorted(self.keyword_points, key=len, reverse=True)
        self.level_points = {level: points for _, level, points in rows["no_match_levels"]}
        self.rank = sorted(self.level_points, key=lambda level: -self.level_points[level])

    @staticmethod
    def search(text, entries, strip):
        found = []
        for entry in entries:
            if entry in text:
                found.append(entry)
                text = text.replace(entry, "")
                text = text.strip() if strip else text
        return found, text

    def find_keywords(self, text):
        if "and" not in text:
            return self.search(text, self.keywords, True)[0]
        found = []
        for piece in text.split("and"):
            piece = piece.strip()
            if piece in self.keyword_points:
                found.append(piece)
            else:
                found += [w for w in piece.split(" ") if w in self.keyword_points]
        return found

    def score(self, title):
        """(branch, level, new title, points)"""
        default = t.DEFAULT_LEVEL
        found, rest = self.search(title, self.levels, True)
        mapped = [self.level_map[x] for x in found]
        levels = sorted((x for x in mapped if x in self.rank), key=self.rank.index)
        targets, _ = self.search(title, self.targets, False)
        if title in self.targets:
            return "exact", default, title, self.matrix[default, title]
        if targets:
            level = levels[0] if levels else default
            best = max(targets, key=lambda x: self.matrix[level, x])
            return "level" if levels else "target", level, best, self.matrix[level, best]
        keywords = self.find_keywords(rest)
        points = 50 + sum(self.keyword_points[k] for k in keywords)
        if levels:
            points += self.level_points[levels[0]]
        name = " ".join(keywords) if keywords else None
        return "keywords", levels[0] if levels else None, name, points


def titles():
    words = (
        "red blue large new cold hot old small ring bolt widget anvil gear gizmo plate rod "
        "senior lead and household machinery building candid xx"
    ).split()
    rng = random.Random(7)
    made = {" ".join(p) for p in itertools.product(words, words)}
    made |= {" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(800)}
    made |= {"".join(rng.choices(words, k=3)) for _ in range(200)}
    return sorted(made | {" ring", "ring ", "", "  ", "oolded", "larglargee widget"})


def test_score_follows_the_rule(spark, frame):
    rule = Rule(SHEETS)
    made = titles()
    sheets = s.prepare_sheets(dims(spark))
    scored = s.score_title(frame(made, "title string"), sheets, "title")
    rows = scored.select("title", "score.*").collect()
    assert len(rows) == len(made)
    expected = {title: rule.score(title) for title in made}
    assert {e[0] for e in expected.values()} == {"exact", "level", "target", "keywords"}
    for r in rows:
        assert (r.title_level, r.new_title, r.points) == expected[r.title][1:], r.title


def test_searches_on_whole_texts(spark):
    rule = Rule(DOC_SHEETS)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.select("doc_id", t.squash_title(F.col("text")).alias("title"))
    sheets = s.prepare_sheets(dims(spark, DOC_SHEETS))
    found = s.find_keywords(s.find_targets(s.find_levels(docs, sheets, "title"), sheets, "title"), sheets, "title")
    cut = 0
    for r in found.collect():
        levels, rest = rule.search(r.title, rule.levels, True)
        assert [e.entry for e in r.levels.found] == levels
        assert r.levels.rest == rest
        assert [e.entry for e in r.targets.found] == rule.search(r.title, rule.targets, False)[0]
        assert [e.entry for e in r.keywords] == rule.find_keywords(r.title)
        cut += "and" in r.title
    assert cut


def sheet(spark, values, columns):
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


@pytest.fixture
def odd_dims(spark):
    """Repeated keys, an empty cell, an unranked level, equal lengths, no spelling."""
    return {
        "title_matrix": sheet(
            spark,
            "(1,'data','individual contributer',10), (1,'data','manager',20),"
            "(2,'data set','individual contributer',90), (2,'data set','manager',95),"
            "(3,'cell','individual contributer',NULL), (3,'cell','manager',60),"
            "(4,'twin','individual contributer',10), (4,'twin','manager',20)",
            "pos, title, level, points",
        ),
        "mapping": sheet(spark, "(1,'x','y')", "pos, old, new").where("pos > 1"),
        "level_mapping": sheet(
            spark,
            "(1,'head','nowhere'), (2,'boss','individual contributer'), (3,'boss','manager'), (4,'','manager')",
            "pos, actual, sfdc",
        ),
        "keywords": sheet(
            spark, "(1,'ab',1), (2,'bc',2), (3,'ab',5), (4,'a b',7)", "pos, keyword, points"
        ),
        "no_match_levels": sheet(
            spark, "(1,'individual contributer',0), (2,'manager',8)", "pos, job_level, points"
        ),
    }


def test_odd_sheets(frame, odd_dims):
    expected = {
        "data set": ("individual contributer", "data set", 90),  # whole title is a target
        "my data set": ("individual contributer", "data", 10),  # sheet order, not length
        "twin data": ("individual contributer", "data", 10),  # equal points: first found
        "boss data": ("manager", "data", 20),  # the last mapping of a level counts
        "head data": ("individual contributer", "data", 10),  # unranked level is ignored
        "head": (None, None, 50),
        "cells": ("individual contributer", "cell", None),
        "boss cells": ("manager", "cell", 60),
        "abc": (None, "ab", 55),  # equal lengths in sheet order; last points count
        "a b and ab ab": (None, "a b ab ab", 67),
        None: (None, None, None),
    }
    made = list(expected)
    rows = s.score_title(frame(made, "title string"), s.prepare_sheets(odd_dims), "title").collect()
    found = {r.title: tuple(r.score) if r.score else (None, None, None) for r in rows}
    assert found == expected
    assert s.unranked_levels(odd_dims).first()[0] == 1


def test_clean_title(spark, frame):
    df = frame(
        ["Old  Gizmo", "old gizmo (x)", "Small_Rod", "VP – Données", None], "JobTitle string"
    )
    whole = {r.JobTitle: r.cleanTitle for r in s.clean_title(df, dims(spark)).collect()}
    assert whole == {
        "Old  Gizmo": "red ring",
        "old gizmo (x)": "old gizmo x ",
        "Small_Rod": "gear",
        "VP – Données": "vp donn es",
        None: None,
    }
    parts = s.clean_title(df, dims(spark), per_token=True).collect()
    assert {r.JobTitle: r.cleanTitle for r in parts} == {
        "Old  Gizmo": "old widget",
        "old gizmo (x)": "old widget x ",
        "Small_Rod": "small rod",
        "VP – Données": "vp donn es",
        None: None,
    }


def test_clean_title_tokens(spark, frame):
    df = frame(
        ["MR", "No longer with us", None, "1 2 x", "Gizmo-Lead, EMEA 2 b", "unknown!"],
        "title string",
    )
    rows = s.clean_title_tokens(df, s.prepare_sheets(dims(spark))).collect()
    assert {r.title: r.title_split for r in rows} == {
        "gizmo-lead, emea 2 b": "widget lead emea",
        "unknown!": "unknown",
    }


def test_plain_rule_of_squashing(apply):
    texts = ["A--B", "a_b", " é x", "İK", "😀"]
    plain = [re.sub(r"[\W_]+", " ", x, flags=re.ASCII).lower() for x in texts]
    assert apply(texts, t.squash_title) == plain
