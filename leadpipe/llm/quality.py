"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per text.  The ledger keeps what was measured and
one bit per failed rule, so policies can be changed, compared and taken apart
later by bit operations alone, without reading a text again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.llm import words as W

WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long"
)

# Bit of each rule, and the failure as SQL over the measurements (integers only, so exact).
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_words": "n_words > 1000000",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
# Rules of each policy version.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "symbols"],
    "v2": [*RULES],
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The measurements of each text, see MEASURES.

    Words are runs of anything but ASCII white space.  Words, lines and windows
    count as equal where their 64-bit hashes are.
    """
    data, at = W.buffers(texts)
    found = W.Runs(data, at, W.NOT_SPACE)
    per_text = lambda table: W.sums(table[data], at)
    starts_char = (np.arange(256) & 0xC0) != 0x80
    lines = W.Runs(data, at, W.NOT_NEWLINE)
    worded = np.searchsorted(found.start, lines.end) > np.searchsorted(found.start, lines.start)
    _, again = W.repeated(lines.hash + W.mix(lines.owner.astype(np.uint64)))
    return [
        found.count,
        per_text(starts_char & ~W.SPACE),
        per_text(SYMBOLS),
        W.sums(worded, lines.first),
        W.sums(worded & again, lines.first),
        _covered(found),
    ]


def _covered(found: W.Runs) -> np.ndarray:
    """Words per text in windows that occur twice or more in it, all occurrences counted."""
    hashes = W.windows(found.hash, WINDOW)
    places = np.flatnonzero(W.whole(found.first, len(hashes), WINDOW))
    owner = found.owner[places].astype(np.uint64)
    often, _ = W.repeated(hashes[places] + W.mix(owner))
    edge = np.zeros(len(found.hash) + WINDOW + 1, np.int64)
    np.add.at(edge, places[often], 1)
    np.add.at(edge, places[often] + WINDOW, -1)
    return W.sums(np.cumsum(edge)[: len(found.hash)] > 0, found.first)


def ledger(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, all measurements, and `failed`, the bits of the rules it fails.

    A null text counts as empty and fails `few_words`; repeated rows stay repeated;
    an empty table gives an empty ledger; other columns are left out.
    """
    measured = W.map_texts(docs, measure, MEASURES, [id], text)
    bits = [F.when(F.expr(fails), bit(rule)).otherwise(0) for rule, fails in RULES.items()]
    return measured.withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def passes(policy: str = CURRENT, failed: str | Column = "failed") -> Column:
    """Does a ledger row pass all rules of the policy."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(mask(policy))) == 0


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it rejects, and that are
    kept without it.

    The ledger is first counted by its failure bits, at most one row for each set of
    rules, whatever the number of documents.
    """
    sets = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]]))
    each = sets.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    count = lambda held: F.sum(F.when(held, F.col("n")).otherwise(0))
    without = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fail"),
        count(F.col("bits") == F.col("bit")).alias("only"),
        count(without == 0).alias("kept_without"),
    )
