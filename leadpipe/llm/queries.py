"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpipe.llm import bpe, chat, credentials, decontaminate, langid, neardup, periods, pieces, quality, repair, spans, toxicity, warc

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    """Register a query, with SQL where that can express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id", 4, 2))
    learned = langid.learn(docs.where(F.coalesce(~F.col("held_out"), F.lit(True))))
    return langid.predict(docs, learned, keep=["doc_id", "held_out"])


OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS word,
    generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i
  FROM documents),
win AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
      lead(word, 4) OVER o) AS five, lead(i, 4) OVER o AS last
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) >= 2 AS twice FROM win WHERE last IS NOT NULL),
rep AS (
  SELECT w.doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (
      coalesce(x0.twice, false) OR coalesce(x1.twice, false) OR coalesce(x2.twice, false)
      OR coalesce(x3.twice, false) OR coalesce(x4.twice, false)) AS n_repeat_words
  FROM w
  LEFT JOIN twice x0 ON x0.doc_id = w.doc_id AND x0.i = w.i
  LEFT JOIN twice x1 ON x1.doc_id = w.doc_id AND x1.i = w.i - 1
  LEFT JOIN twice x2 ON x2.doc_id = w.doc_id AND x2.i = w.i - 2
  LEFT JOIN twice x3 ON x3.doc_id = w.doc_id AND x3.i = w.i - 3
  LEFT JOIN twice x4 ON x4.doc_id = w.doc_id AND x4.i = w.i - 4
  GROUP BY w.doc_id),
line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM documents d LEFT JOIN rep USING (doc_id) LEFT JOIN line USING (doc_id)),
book AS (SELECT *, (%(bits)s)::BIGINT AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  failed & %(base)s <> 0 AS base_failed, failed & %(policy)s = 0 AS kept
FROM book
""" % {
    "bits": " + ".join(f"CASE WHEN {x} THEN {quality.bit(r)} ELSE 0 END" for r, x in quality.RULES.items()),
    "base": quality.mask("base"),
    "policy": quality.mask(quality.CURRENT),
}


@query("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "failed",
        (~quality.passes("base")).alias("base_failed"),
        quality.passes().alias("kept"),
    )


@query("op7_secret_scans")
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.classify(table(spark, sf_dir, "documents")))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.digests(bpe.decode(encoded, RANKS, public_tokenizers.PATTERN))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periods.digests(periods.find(docs, keep=["doc_id"], tails=periods.tail_code("doc_id")))


def _way(letter: str, cost: str, then: str, when: str | None = None) -> str:
    """An edit in front of the best edits from a state of the next row on, as SQL."""
    way = f"{{'cost': {cost} + {then}.cost, 'edits': '{letter}' || {then}.edits}}"
    return f"CASE WHEN {when} THEN {way} END" if when else way


def _state(state: str, ways: dict[str, str]) -> str:
    """The best edits of a row from a state on; `ways` has the next state for each initial, as SQL."""
    keeps = [_way("K", "more", f"n.{then}", f"NOT gone AND initial = '{i}'") for i, then in ways.items()]
    changes = [_way("R", "3 + more", f"n.{then}", "NOT gone") for i, then in ways.items() if i in "ua"]
    return f"list_min([{', '.join([_way('D', '4', f'n.{state}'), *keeps, *changes])}]) AS {state}"


OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS bits FROM range(256) t(i)),
said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
    lambda c, b: xor(c >> 8, bits[(xor(c, b) & 255) + 1]))) %% 20 AS chance
  FROM conversations, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN chance = 4 THEN 'user' ELSE role END AS role,
    CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM said, range(2) t(i) WHERE chance <> 0 AND (i = 0 OR chance = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
    left(role, 1) AS initial FROM damaged),
checked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY place) AS pair
  FROM ordered),
kind AS (
  SELECT conv_id, place, initial, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more FROM checked),
best AS (
  SELECT conv_id, max(place) + 1 AS place, {'cost': 0, 'edits': ''} AS b, {'cost': 6, 'edits': 'II'} AS s,
    {'cost': 3, 'edits': 'I'} AS u, {'cost': 0, 'edits': ''} AS a
  FROM kind GROUP BY conv_id
  UNION ALL
  SELECT conv_id, place, %(begin)s AS b, %(system)s AS s, %(user)s AS u, %(assistant)s AS a
  FROM (
    SELECT k.conv_id, k.place, %(states)s
    FROM best n JOIN kind k ON k.conv_id IS NOT DISTINCT FROM n.conv_id AND k.place = n.place - 1)),
plan AS (SELECT conv_id, b.cost AS cost, b.edits AS audit FROM best WHERE place = 1),
edit AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS place,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY i DESC) AS remaining
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i
    FROM plan WHERE audit <> '')),
repaired AS (
  SELECT e.conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN remaining %% 2 = 1 THEN 'assistant' ELSE 'user' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS repaired
  FROM edit e LEFT JOIN checked r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.place = e.place
  WHERE edit <> 'D' GROUP BY e.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN plan p ON p.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
""" % {
    "states": ", ".join(
        _state(state, ways)
        for state, ways in {"b": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}.items()
    ),
    "begin": f"list_min([b, {_way('I', '3', 'u')}, {_way('II', '6', 'a')}])",
    "system": f"list_min([s, {_way('I', '3', 'u')}, {_way('II', '6', 'a')}])",
    "user": f"list_min([u, {_way('I', '3', 'a')}])",
    "assistant": f"list_min([a, {_way('I', '3', 'u')}])",
}


@query("op11_conversation_repair", OP11_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    bad = repair.damaged(turns)
    return repair.digests(bad, repair.saved(repair.plan(bad, turns)))


MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), MODEL, keep=["doc_id"])
    return pieces.digests(pieces.decode(encoded, MODEL))


@query("op8_dart_minhash")
def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op6_sentence_spans")
def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove(table(spark, sf_dir, "documents"))


@query("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


PROBE = r"\### Assistant: </turn> ok"
OP3_SQL = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
turn AS (
  SELECT *, regexp_matches(text, '###|</turn>') AS escaped,
    len(regexp_replace(text, '(###|</turn>)', '\\\1', 'g')) AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(15 + chars + CASE WHEN escaped THEN 10 ELSE 0 END
    + CASE WHEN regexp_matches(role, '^[a-z]+$') THEN len(role) ELSE 1 + len(url_encode(role)) END)::BIGINT
    AS formatted_chars,
  true AS round_trip
FROM turn GROUP BY conv_id
"""


@query("op3_chat_formatting", OP3_SQL)
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(PROBE).alias("text")
    ids = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    probe = ids.select("conv_id", "turn", F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), said)
    return chat.digest(chat.format(turns.unionByName(probe)))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.held_out("doc_id", 5, 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", out.alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~out)
    return toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id", "held_out"])


OP2_SQL = """
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages),
sized AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM payload),
first AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR page_id = least THEN NULL ELSE least END AS refers_to
FROM first
"""


@query("op2_arc_to_warc", OP2_SQL)
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_as_warc(table(spark, sf_dir, "pages")).drop("record_id")


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
